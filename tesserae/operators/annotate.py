"""Annotating tile variants against the reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions.diff import variants_udf
from tesserae.functions.hgvs import format_variant, pad_left

TAG_LENGTH = 24
#: A variant that spans more reference tiles than this isn't compared.
MAX_SPAN = 100


def spanned_reference(variants: DataFrame, ref_tiles: DataFrame, tags: DataFrame, ref_seqs: DataFrame, k: int = TAG_LENGTH) -> DataFrame:
    """Variants (tag, hash, seq) with what they stand against: seqname, pos, ref_seq, span (tiles).

    A variant that lacks the next tag runs on to a later one: its last bases name that tag, whose place on
    the reference ends the stretch. The last tile of a chromosome ends with it. Two equi-joins with the
    tiles. Only distinct stretches of two tiles or more are put together, from chunks of the reference; a stretch of
    over MAX_SPAN tiles, which is never compared, has no ref_seq.
    """
    place = ref_tiles.select("tag", "seqname", "pos", "len", F.col("seq").alias("own"), F.row_number().over(Window.partitionBy("seqname").orderBy("pos")).alias("nth"))
    ends = tags.join(place.select("tag", F.col("seqname").alias("end_name"), F.col("pos").alias("end_pos"), F.col("nth").alias("end_nth")), "tag").drop("tag")
    rows = variants.join(place, "tag").withColumn("end_tag", F.expr(f"right(seq, {k})"))
    rows = rows.join(ends, (rows["end_tag"] == ends["tagseq"]) & (rows["seqname"] == ends["end_name"]) & (ends["end_pos"] > rows["pos"]), "left").drop("tagseq", "end_name", "end_tag")
    direct = F.col("end_pos").isNull() | (F.col("end_nth") == F.col("nth") + 1)
    span, end = F.when(direct, 1).otherwise(F.col("end_nth") - F.col("nth")), F.when(direct, F.col("pos") + F.col("len")).otherwise(F.col("end_pos") + k)
    rows = rows.withColumn("span", span).withColumn("end", end)
    stretches = rows.where((F.col("span") > 1) & (F.col("span") <= MAX_SPAN)).select("seqname", F.col("pos").alias("start"), "end").distinct()
    cut = reference_stretches(stretches, ref_seqs).select("seqname", F.col("start").alias("pos"), "end", F.col("seq").alias("_stretch"))
    rows = rows.join(cut, ["seqname", "pos", "end"], "left")
    ref_seq = F.when(F.col("span") == 1, F.col("own")).otherwise(F.col("_stretch"))
    return rows.select(*variants.columns, "seqname", "pos", ref_seq.alias("ref_seq"), "span", "end")


def reference_stretches(stretches: DataFrame, ref_seqs: DataFrame, chunk: int = 1 << 16) -> DataFrame:
    """``stretches`` (seqname, start, end; distinct) with seq, the reference there, by an equi-join with chunks of it.

    No row but the reference's own carries a chromosome, and a stretch is put together from the few chunks it meets.
    """
    data = F.encode("seq", "UTF-8")
    starts = F.sequence(F.lit(0), F.greatest(F.length("seq") - 1, F.lit(0)), F.lit(chunk))
    pieces = F.transform(starts, lambda o: F.decode(F.substring(data, o + 1, F.lit(chunk)), "UTF-8"))
    chunks = ref_seqs.select("seqname", F.posexplode(pieces).alias("_n", "_part"))
    first, last = F.floor(F.col("start") / chunk).cast("int"), F.floor((F.col("end") - 1) / chunk).cast("int")
    wanted = stretches.withColumn("_n", F.explode(F.sequence(first, F.greatest(first, last))))
    met = wanted.join(chunks, ["seqname", "_n"]).groupBy("seqname", "start", "end").agg(F.array_sort(F.collect_list(F.struct("_n", "_part"))).alias("_parts"))
    whole = F.array_join(F.transform("_parts", lambda p: p["_part"]), "")
    at = F.col("start") - F.element_at("_parts", 1)["_n"] * chunk
    return met.select("seqname", "start", "end", F.substring(whole, (at + 1).cast("int"), (F.col("end") - F.col("start")).cast("int")).alias("seq"))


def differences(pairs: DataFrame, max_size: int = 50_000, max_apart: int = 1000) -> DataFrame:
    """Pairs (seq, ref_seq, span, ...) with ``changes``: null where a side is unknown, too long or too different.

    Each distinct pair should be one row; join the result back to calls rather than comparing per call.
    """
    fit = (F.length("seq") <= max_size) & (F.length("ref_seq") <= max_size) & (F.abs(F.length("seq") - F.length("ref_seq")) <= max_apart) & (F.col("span") <= MAX_SPAN)
    return pairs.withColumn("changes", variants_udf(F.upper("ref_seq"), F.when(fit, F.upper("seq"))))


def annotations(ranked: DataFrame, compared: DataFrame, ref: DataFrame, outcols: DataFrame) -> DataFrame:
    """Annotation rows: ``=`` for the reference's own variant, a blank one where nothing could be compared, else one
    for each change, placed on the chromosome."""
    rows = ranked.select("tag", "hash", "variant").join(compared, ["tag", "hash"]).join(ref.select("tag", F.col("hash").alias("_ref")), "tag", "left").join(outcols, "tag")
    is_ref = F.col("hash") == F.col("_ref")
    none = F.struct(F.lit(0).alias("position"), F.lit("").alias("ref"), F.lit("").alias("new"), F.lit("").alias("left"))
    kept = F.when(is_ref | F.col("changes").isNull(), F.array(none)).otherwise(F.col("changes"))
    spread = rows.withColumn("c", F.explode(kept))
    position = F.col("pos") + F.col("c.position")
    text = F.concat("seqname", F.lit(":g."), format_variant(position, F.col("c.ref"), F.col("c.new")))
    hgvs = F.when(is_ref, "=").when(F.col("changes").isNull(), "").otherwise(text)
    return spread.select("tag", "outcol", "variant", hgvs.alias("hgvs"), "seqname", position.cast("long").alias("position"), F.col("c.ref").alias("ref"), F.col("c.new").alias("new"), F.col("c.left").alias("left"))


def reference_rows(annotated: DataFrame, ref_variants: DataFrame) -> DataFrame:
    """One row for each change, of the reference's own variant of the tile: the change's place, with new as ref."""
    own = ref_variants.select("tag", F.col("variant").alias("_own"))
    rows = annotated.where(~F.col("hgvs").isin("", "=")).select("tag", "outcol", "hgvs", "seqname", "position", "ref", "left").distinct().join(own, "tag")
    return rows.select("tag", "outcol", F.col("_own").alias("variant"), F.lit("=").alias("hgvs"), "seqname", "position", "ref", F.col("ref").alias("new"), "left")


def hashed_annotations(annotated: DataFrame, ranked: DataFrame, digits: int = 13) -> DataFrame:
    """Rows as (tag, outcol, hash prefix, hgvs) for libraries whose numbers aren't comparable."""
    rows = annotated.where(~F.col("hgvs").isin("", "="))
    return rows.join(ranked.select("tag", "variant", "hash"), ["tag", "variant"]).select("tag", "outcol", F.substring("hash", 1, digits).alias("hash"), "hgvs")


def annotation_records(annotated: DataFrame, by: Column | None = None) -> DataFrame:
    """VCF records of annotations: identical calls are one record whose TV lists every tile variant.

    Calls are ordered by position, length of the deletion, insertion, tile and variant; the record takes
    the id and the deletion of the last.
    """
    at, ref, new = pad_left(F.col("position"), F.col("ref"), F.col("new"), F.coalesce(F.col("left"), F.lit("")))
    rows = annotated.where(~F.col("hgvs").isin("", "=")).select("seqname", at.alias("pos"), ref.alias("ref"), new.alias("alt"), "tag", "variant", "hgvs")
    pairs = F.array_sort(F.collect_list(F.struct("tag", "variant", "hgvs", "ref")))
    merged = rows.groupBy("seqname", "pos", F.length("ref").alias("n"), "alt").agg(pairs.alias("calls"))
    last = F.element_at("calls", -1)
    names = F.array_join(F.transform("calls", lambda c: F.concat(c["tag"].cast("string"), F.lit("-"), c["variant"].cast("string"))), ",")

    def shown(c):
        return F.when(F.length(c) == 0, ".").otherwise(c)

    return merged.select("seqname", "pos", last["hgvs"].alias("id"), shown(last["ref"]).alias("ref"), shown(F.col("alt")).alias("alt"), F.concat(F.lit("TV=,"), names, F.lit(",")).alias("info"))


def hit_rates(records: DataFrame, name: str = "seqname") -> DataFrame:
    """Share of records with an rsID and with a population frequency, by chromosome and overall (null), in per cent."""
    return records.rollup(name).agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("rsid").isNotNull(), 100.0).otherwise(0.0)), 6).alias("rsid_rate"), F.round(F.avg(F.when(F.col("af").isNotNull(), 100.0).otherwise(0.0)), 6).alias("af_rate"))
