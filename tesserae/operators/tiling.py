"""Cutting sequences into tiles at tags."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TAG_LENGTH = 24


def kmers(rows: DataFrame, k: int, chunk: int = 256) -> DataFrame:
    """(columns but seq, pos, kmer) of every k-mer of ``seq`` (ASCII).

    A sequence is cut into chunks that overlap by k - 1 bases, and chunks into k-mers, so that no row
    carries a whole sequence and no base is far from the start of its string. Chunks are dealt out before
    they are cut, so one long chromosome is the work of many tasks.
    """
    own = [c for c in rows.columns if c != "seq"]
    data = F.encode("seq", "UTF-8")
    starts = F.sequence(F.lit(0), F.length("seq") - k, F.lit(chunk))
    cut = F.transform(starts, lambda o: F.struct(o.alias("at"), F.decode(F.substring(data, o + 1, F.lit(chunk + k - 1)), "UTF-8").alias("part")))
    parts = rows.where(F.length("seq") >= k).select(*own, F.explode(cut).alias("_c"))
    parts = parts.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *own, "_c.at")
    grams = F.transform(F.sequence(F.lit(1), F.length("_c.part") - k + 1), lambda i: F.substring(F.col("_c.part"), i, F.lit(k)))
    return parts.select(*own, F.col("_c.at").alias("_at"), F.posexplode(grams).alias("_i", "kmer")).select(*own, (F.col("_at") + F.col("_i")).cast("long").alias("pos"), "kmer")


def kmer_hits(contigs: DataFrame, tags: DataFrame, k: int = TAG_LENGTH) -> DataFrame:
    """(contig columns but seq, tag, pos) of every tag found in ``seq``, overlapping hits included: an equi-join of k-mers."""
    small = tags.limit(1_000_001).count() <= 1_000_000
    return kmers(contigs, k).join(F.broadcast(tags) if small else tags, F.col("kmer") == F.col("tagseq")).drop("kmer", "tagseq")


def greedy_hits(hits: DataFrame, k: int = TAG_LENGTH, key: tuple[str, ...] = ("file", "sample", "phase", "seqname")) -> DataFrame:
    """Of overlapping hits the first, scanning from the left: (key, hits) with hits an array of (pos, tag).

    A hit ends the window, so the next begins after it. One ordered pass over the sorted hits of a partition; only the
    hits kept of one contig, far fewer than its bases, are held at once.
    """
    parts = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = hits.select(*key, F.col("pos").cast("long").alias("pos"), F.col("tag").cast("long").alias("tag")).repartition(parts, *key).sortWithinPartitions(*key, "pos", "tag")
    names = ", ".join(f"{c} {ordered.schema[c].dataType.simpleString()}" for c in key)
    kind = pa.list_(pa.struct([("pos", pa.int64()), ("tag", pa.int64())]))

    def run(batches):
        own, kept, end = None, [], 0
        fields = None

        def row():
            return pa.RecordBatch.from_arrays([*(pa.array([v], f.type) for v, f in zip(own, fields)), pa.array([kept], kind)], [*key, "hits"])

        for batch in batches:
            fields = [batch.schema.field(c) for c in key]
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*key, "pos", "tag")]
            for *name, pos, tag in zip(*columns):
                if name != own:
                    if own is not None:
                        yield row()
                    own, kept, end = name, [], 0
                if pos >= end:
                    kept.append({"pos": pos, "tag": tag})
                    end = pos + k
        if own is not None:
            yield row()

    return ordered.mapInArrow(run, f"{names}, hits array<struct<pos:long,tag:long>>")


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence; of equal values the later one is taken."""
    tails: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
        before.append(at[k - 1] if k else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _hits_kept(hits: DataFrame, keep) -> DataFrame:
    """``hits`` with each array cut down to the hits that ``keep`` names by their places, given their tags."""
    at = hits.columns.index("hits")

    def run(batches):
        for batch in batches:
            kept = [[own[i] for i in keep([h["tag"] for h in own])] for own in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(kept, batch.schema.field(at).type))

    return hits.mapInArrow(run, hits.schema)


def in_order(hits: DataFrame) -> DataFrame:
    """Hits (arrays of pos, tag) without those out of the order of tags: a longest increasing run of tags stays."""
    return _hits_kept(hits, longest_increasing)


def placed_once(tags: list[int]) -> list[int]:
    """Places of the tags that are there once."""
    times = Counter(tags)
    return [i for i, t in enumerate(tags) if times[t] == 1]


def without_duplicates(hits: DataFrame) -> DataFrame:
    """Hits (arrays) without tags that are found twice or more on the contig."""
    return _hits_kept(hits, placed_once)


#: Letters as two bits, anything else 4.
_CODES = np.full(256, 4, np.uint8)
_CODES[list(b"acgt")] = range(4)
#: Bases that are looked up at once.
PIECE = 1 << 20


def tag_index(tags: list[tuple[str, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the tags' bases, two bits each, in order; their tags). Tags of other letters or lengths match nothing."""
    known = [(t.lower(), n) for t, n in tags if len(t) == k and not set(t.lower()) - set("acgt")]
    if not known:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = _CODES[np.frombuffer("".join(t for t, _ in known).encode(), np.uint8)].reshape(-1, k).astype(np.uint64)
    numbers = np.zeros(len(known), np.uint64)
    for j in range(k):
        numbers = numbers << np.uint64(2) | codes[:, j]
    order = np.argsort(numbers, kind="stable")
    return numbers[order], np.array([n for _, n in known], np.int64)[order]


def scan(seq: str, index: tuple[np.ndarray, np.ndarray] | dict[str, int], k: int, piece: int = PIECE) -> list[tuple[int, int]]:
    """(tag, pos) found from the left; the window is cleared by a hit and by anything but a, c, g and t.

    All windows of a piece become numbers and are looked up in the sorted index (of ``tag_index``, or made here from a few
    tags by their bases) together, so that only the hits are taken one by one.
    """
    numbers, tags = tag_index(list(index.items()), k) if isinstance(index, dict) else index
    out, end = [], 0
    if not len(numbers) or len(seq) < k:
        return out
    codes = _CODES[np.frombuffer(seq.encode("ascii", "replace"), np.uint8)]
    for first in range(0, len(codes) - k + 1, piece):
        own = codes[first : first + piece + k - 1]
        n = len(own) - k + 1
        grams = np.zeros(n, np.uint64)
        for j in range(k):
            grams = grams << np.uint64(2) | (own[j : j + n] & 3)
        unknown = np.concatenate(([0], np.cumsum(own > 3)))
        place = np.minimum(np.searchsorted(numbers, grams), len(numbers) - 1)
        hit = np.flatnonzero((numbers[place] == grams) & (unknown[k:] == unknown[:n]))
        for pos, tag in zip((hit + first).tolist(), tags[place[hit]].tolist()):
            if pos >= end:
                out.append((tag, pos))
                end = pos + k
    return out


#: Tags whose numbers are held by every task; beyond, tags are found by a join.
MOST_TAGS = 50_000_000


def tile_contigs(contigs: DataFrame, tags: DataFrame, k: int = TAG_LENGTH, keep_duplicates: bool = False, skip_out_of_order: bool = False, most_tags: int = MOST_TAGS) -> tuple[DataFrame, DataFrame]:
    """Tiles (contig columns, step, tag, start, end, seq) and statistics of each contig.

    One pass over the contigs. Up to ``most_tags`` tags, counted first, are broadcast as sorted numbers of 16 bytes a
    tag; with more of them, or tags over 31 bases, the hits come from a join of k-mers and are joined to their contigs.
    A contig without tags has no tiles but a row of statistics.
    """
    spark = contigs.sparkSession
    own = [f for f in contigs.schema.fields if f.name != "seq"]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own)
    head = [(f.name, pa.int32() if f.dataType.simpleString() == "int" else pa.int64() if f.dataType.simpleString() == "bigint" else pa.string()) for f in own]
    out_schema = pa.schema([*head, ("step", pa.int32()), ("tag", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("tile", pa.string()), ("length", pa.int64()), ("bases", pa.int64()), ("dropped_dup", pa.int64()), ("dropped_ooo", pa.int64())])
    if k <= 31 and tags.limit(most_tags + 1).count() <= most_tags:
        table = spark.sparkContext.broadcast(tag_index([(r.tagseq, r.tag) for r in tags.select("tagseq", "tag").toLocalIterator()], k))
        rows = contigs
    else:
        table = None
        names = tuple(f.name for f in own)
        lower = contigs.withColumn("seq", F.lower("seq"))
        hits = greedy_hits(kmer_hits(lower, tags.select("tag", F.lower("tagseq").alias("tagseq")), k), k, names)
        rows = contigs.join(hits.withColumnsRenamed({n: f"_{n}" for n in names}), [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names], "left").select(*names, "seq", "hits")

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                seq = (row["seq"] or "").lower()
                hits = scan(seq, table.value, k) if table else [(h["tag"], h["pos"]) for h in row["hits"] or ()]
                found = len(hits)
                if not keep_duplicates:
                    hits = [hits[i] for i in placed_once([t for t, _ in hits])]
                dup = found - len(hits)
                if skip_out_of_order:
                    hits = [hits[i] for i in longest_increasing([t for t, _ in hits])]
                ooo = found - dup - len(hits)
                bases = sum(map(seq.count, "acgt"))
                base = [row[f.name] for f in own]
                made = [[*base, None, None, None, None, None, len(seq), bases, dup, ooo]]
                for i, (t, p) in enumerate(hits):
                    a, b = (p if i else 0), (hits[i + 1][1] + k if i + 1 < len(hits) else len(seq))
                    made.append([*base, i, t, a, b, seq[a:b], None, None, None, None])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), out_schema)], schema=out_schema)

    both = rows.mapInArrow(run, f"{ddl}, step int, tag int, start long, end long, tile string, length long, bases long, dropped_dup long, dropped_ooo long")
    names = [f.name for f in own]
    tiles = both.where("tag is not null").select(*names, "step", "tag", "start", "end", F.col("tile").alias("seq"))
    stats = both.where("length is not null").select(*names, "length", "bases", "dropped_dup", "dropped_ooo")
    return tiles, stats


def import_statistics(tiles: DataFrame, stats: DataFrame) -> DataFrame:
    """Contig statistics with the number of tiles on its path."""
    keys = [c for c in stats.columns if c not in ("length", "bases", "dropped_dup", "dropped_ooo")]
    paths = tiles.groupBy(*keys).agg(F.count("*").alias("path_length"))
    joined = stats.join(paths.withColumnsRenamed({c: f"_{c}" for c in keys}), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys], "left")
    return joined.drop(*(f"_{c}" for c in keys)).withColumn("path_length", F.coalesce("path_length", F.lit(0)))


def calls_of(tiles: DataFrame, retain_no_calls: bool = False) -> DataFrame:
    """Calls (sample, tag, phase, hash, known) of tiles; the hash is of the lower-case bases."""
    return tiles.select("sample", "tag", "phase", F.sha2("seq", 256).alias("hash"), (~F.col("seq").rlike("[^acgt]") | F.lit(retain_no_calls)).alias("known"))


def variants_of(tiles: DataFrame, is_ref: bool = False) -> DataFrame:
    """Distinct tile variants (tag, hash, seq, is_ref) of tiles; seq is null where bases aren't known."""
    known = ~F.col("seq").rlike("[^acgt]")
    return tiles.select("tag", F.sha2("seq", 256).alias("hash"), F.when(known, F.col("seq")).alias("seq"), F.lit(is_ref).alias("is_ref")).distinct()


def kept_and_dropped(tiles: DataFrame) -> DataFrame:
    """Tags placed once and tags placed more often, of each haplotype."""
    n = tiles.groupBy("sample", "phase", "tag").agg(F.count("*").alias("n"))
    return n.groupBy("sample", "phase").agg(F.count_if(F.col("n") == 1).alias("kept"), F.count_if(F.col("n") > 1).alias("dropped"))


def flatten_haplotypes(calls: DataFrame) -> DataFrame:
    """(sample, variants): phases side by side by tag, 0 where a haplotype has no call."""
    top = calls.groupBy("sample").agg(F.max("tag").alias("top"), F.map_from_entries(F.collect_list(F.struct((2 * F.col("tag") + F.col("phase")).cast("int").alias("k"), "variant"))).alias("m"))
    cells = F.transform(F.sequence(F.lit(0), (2 * F.col("top") + 1).cast("int")), lambda c: F.coalesce(F.element_at("m", c), F.lit(0)))
    return top.select("sample", cells.alias("variants"))


def numbered_steps(path: DataFrame) -> DataFrame:
    """A path with ``step`` from the order of its tiles."""
    return path.withColumn("step", F.row_number().over(Window.partitionBy("seqname").orderBy("start")) - 1)
