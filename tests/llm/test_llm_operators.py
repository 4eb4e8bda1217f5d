"""The operators against brute force, on small tables with nulls, empty and long texts, ties and odd columns."""

import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserae.llm import decontamination, html_extract, idfiles, packing, quality, sharding, simhash, substring_dedup, suffix_dedup, toxicity, windows
from tesserae.llm.common import scratch_dir
from tesserae.llm.components import components
from tesserae.llm.encode import Encoder, default_path
from tesserae.llm.suffix_array import suffix_array

#: Columns whose names the operators use themselves.
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("fp", T.StringType()), T.StructField("runs", T.StringType()), T.StructField("kept", T.BooleanType()), T.StructField("n_chars", T.LongType()), T.StructField("_key", T.LongType()), T.StructField("_doc", T.LongType()), T.StructField("n_words", T.StringType())])


def rows_of(texts):
    """(doc_id, text, ...): the ids of two rows are null, and one row comes twice."""
    rows = [(None if k in (3, 4) else k, t, "x", None, None, len(t or ""), k, None, None) for k, t in enumerate(texts)]
    return [*rows, rows[0]]


def corpus(seed=1, n=40):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(120)]
    texts = [None, "", "   \n\t ", "one", "two three"]
    for k in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 200, 400]))]
        if k % 3 == 0:
            at, cut = rng.randrange(len(words)), rng.randrange(60)
            words[at:at] = passage[cut:]
        if k % 7 == 0:
            words[-1:] = ["Word,\n", "a  b"]
        texts.append(" ".join(words))
    texts += [texts[10], texts[10] + " end", "ab" * 900, "ab" * 900 + "c", "a" * 30_000, "same same " * 4_000]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(corpus()), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_text(rows, texts_rows, *names):
    """Results as a multiset, in which a row is known by doc_id and values."""
    return sorted((tuple(r[n] for n in names) for r in rows), key=repr)


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(3)
    for _ in range(200):
        size = rng.choice([8, 16, 33])
        lengths = [rng.randint(1, size) for _ in range(rng.randint(1, 60))]
        placed = packing.best_fit(lengths, size)
        # the same by scanning all open windows
        used, slow = [], [None] * len(lengths)
        for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
            fits = [(size - u, w) for w, u in enumerate(used) if u + lengths[k] <= size]
            if fits:
                left = min(f for f, _ in fits)
                slow[k] = left
                w = next(w for f, w in fits if f == left)
                used[w] += lengths[k]
            else:
                slow[k] = size
                used.append(lengths[k])
        assert len({w for w, _ in placed}) == len(used)
        assert [size - offset for _, offset in placed] == slow
        for w in {w for w, _ in placed}:
            spans = sorted((o, o + n) for (v, o), n in zip(placed, lengths) if v == w)
            assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= size


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_gives_the_tokenizers_ids(name):
    enc = Encoder(default_path(name))
    tricky = ["a\nb\n\nc d\n e", "x.\n", "\nx", "a,\n\nb.", " a b ", "a  b", "!!", " ..", "é. Ñ, a'b don't. it's, 12, 3.", "a\tb. c\r\nd", "ABC!! *** x$$$", "ǅ. ɐ. 中文. 中文,a", "<|endoftext|> a <|endoftext|>.", "İa İ. a", "É. ÉA", " ", "\n", "ß. ẞ. ŉ.", "ª. º. aª", "a\x85b c", "😀 😀. a😀", "é. é x"]
    rng = random.Random(5)
    tricky += ["".join(rng.choice("ab é.\n '!1A") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    assert [x for x in tricky if enc.encode(x) != enc.whole(x)] == []


def test_packing_holds_every_id_once(spark, docs, empty):
    enc = Encoder(default_path("byte_bpe_50k.json"))
    pieces = packing.pack(docs, default_path("byte_bpe_50k.json"), block_tokens=5000).collect()
    by_doc = {}
    for r in pieces:
        assert len(r.ids) == 4 * r.length
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    expected = {}
    for row in docs.collect():
        ids = enc.encode(row.text) + packing.END
        expected.setdefault((row.doc_id, len(ids) // 4), []).append(ids)
    assert by_doc.keys() == expected.keys()
    for key, texts in expected.items():
        assert sum(len(b) for _, b in by_doc[key]) == sum(map(len, texts))
        if len(texts) == 1:
            assert b"".join(b for _, b in sorted(by_doc[key])) == texts[0]
    windows_ = {}
    for r in pieces:
        windows_.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    for spans in windows_.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 2048 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert packing.pack(empty, default_path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_are_exact(kind):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4")
        assert (idfiles.from_planes(idfiles.to_planes(ids, kind), n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_id_files_round_trip(spark, docs, empty, kind):
    path = default_path("word_bpe_49k.json")
    enc = Encoder(path)
    manifest = idfiles.write_ids(docs, scratch_dir(spark, "test"), path, file_ids=3000, kind=kind)
    assert manifest.count() > 3
    got = sorted((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in idfiles.read_ids(manifest).select("start", F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "n_tokens", "ids").collect())
    rows = [(-1 if r.doc_id is None else r.doc_id, enc.encode(r.text) + idfiles.END) for r in docs.collect()]
    assert sorted((d, i) for _, d, _, i in got) == sorted(rows)
    assert [d for _, d, _, _ in got] == sorted(d for d, _ in rows)
    assert [s for s, _, _, _ in got] == [0, *np.cumsum([n for _, _, n, _ in got])[:-1].tolist()]
    assert idfiles.read_ids(idfiles.write_ids(empty, scratch_dir(spark, "test"), path)).count() == 0


def test_sharding_table(spark, docs, empty):
    names = sharding.shard_names(7)
    owner = sharding.fill(names, 1009)
    shares = [owner.count(k) for k in range(7)]
    assert max(shares) - min(shares) <= 1
    # the order of the list doesn't matter, and a shard that goes moves little else
    assert [names[k] for k in owner] == [names[::-1][k] for k in sharding.fill(names[::-1], 1009)]
    fewer = sharding.fill(names[:-1], 1009)
    moved = sum(names[a] != names[b] for a, b in zip(owner, fewer) if a != 6)
    assert moved < 0.25 * 1009
    for wrong in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill(wrong)
    with pytest.raises(ValueError):
        sharding.fill(["a"], 1000)
    placed = sharding.shard(docs.withColumn("_shard", F.lit("old")), "doc_id", names, 1009)
    rows = placed.collect()
    assert len(rows) == docs.count() and set(docs.columns) <= set(placed.columns)
    import hashlib

    for r in rows:
        key = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.sha256(key.encode()).hexdigest()[:15], 16) % 1009
        assert (r._slot, r._shard) == (slot, names[owner[slot]])
    assert sharding.shard(empty, "doc_id", names).count() == 0


def test_sharding_table_by_turns():
    """The same table from whole lists of preferences."""
    import hashlib

    for n, slots in ((1, 2), (3, 7), (5, 101), (13, 13), (9, 1009)):
        names = sharding.shard_names(n)
        rng = random.Random(n)
        rng.shuffle(names)
        wishes = {}
        for name in names:
            offset, skip = (int(hashlib.sha256(f"{use}:{name}".encode()).hexdigest()[:16], 16) for use in ("offset", "skip"))
            wishes[name] = [(offset + j * (skip % (slots - 1) + 1)) % slots for j in range(slots)]
            assert sorted(wishes[name]) == list(range(slots))
        owner = {}
        while len(owner) < slots:
            for name in sorted(names):
                if len(owner) < slots:
                    owner[next(s for s in wishes[name] if s not in owner)] = name
        assert [names[k] for k in sharding.fill(names, slots)] == [owner[s] for s in range(slots)]


def test_quality_measures(spark, docs, empty):
    target = spark.createDataFrame([(k,) for k in range(6, 30)] + [(None,)], "doc_id long")
    done = quality.assess(docs, target, carry=["doc_id", "text", "kept", "n_chars"])
    assert done.columns[7:] == ["doc_id", "text", "_carry_kept", "n_chars", "base_failed", "kept"]
    rows = done.collect()
    counts = quality.gram_counts(docs, target)
    weight = quality.weights(counts)
    raw = np.zeros(2 * quality.BUCKETS, np.int64)
    for r in docs.collect():
        np.add.at(raw, quality.grams(*quality._words(r.text)), 1)
    assert (raw == counts[:, 0]).all()
    for r in rows:
        n_words, chars, symbols, dup, repeat, ratio, n_grams, doc, text, _, _, failed, kept = r
        t = text or ""
        words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", t)]
        assert n_words == len(words) and chars == sum(map(len, words)) and symbols == sum(c in "#*$%&|<>" for c in t)
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        assert dup == len(lines) - len(set(lines))
        tri = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        seen = __import__("collections").Counter(tri)
        assert repeat == len({i + k for i, x in enumerate(tri) if seen[x] > 1 for k in range(3)})
        assert failed == (n_words < 50 or 100 * repeat > 50 * n_words)
        assert ratio == sum(int(weight[g]) for g in quality.grams(*quality._words(text)))
        assert kept == (not failed and ratio >= quality.THRESHOLD * n_grams)
    assert quality.assess(empty, target).count() == 0
    none = quality.assess(docs, target.limit(0))
    assert none.where("ratio <> 0").count() == 0
    left = quality.kept_docs(docs, target)
    assert left.columns == docs.columns and left.count() == sum(r[-1] for r in rows)


def test_components_on_long_paths(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100)] + [(200, 200 + k) for k in range(1, 40)] + [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(25)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_links_find_every_pair(spark):
    rng = random.Random(4)
    prints = {0, -1}
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(4):
            y = x
            for b in rng.sample(range(64), rng.randint(0, 6)):
                y ^= 1 << b
            prints.add(y - (1 << 64) if y >> 63 else y)
    for distance in (1, 3, 4, 5):
        got = [(r.u, r.v) for r in simhash.links(spark.createDataFrame([(x, x) for x in prints], "fp long, group long"), distance).collect()]
        assert len(got) == len(set(got))
        assert set(got) == {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}


def test_connected_prints(spark):
    """Groups of near copies, some one bit apart and some only joined by larger steps."""
    rng = random.Random(8)
    prints = {0, -1}
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 40])):
            y = x
            for b in rng.sample(range(64), rng.choice([0, 1, 1, 2, 3, 6])):
                y ^= 1 << b
            prints.add(y - (1 << 64) if y >> 63 else y)
            if rng.random() < 0.3:
                x = y
    parent = {x: x for x in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    touched = set()
    for a in prints:
        for b in prints:
            if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                touched |= {a, b}
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    got = {r.node: r.root for r in simhash.connected(spark.createDataFrame([(x,) for x in prints], "fp long"), 4).collect()}
    assert got == {x: find(x) for x in touched} and len(touched) > 100
    one = {(r.u, r.v) for r in simhash.neighbours(spark.createDataFrame([(x,) for x in prints], "fp long")).collect()}
    assert one == {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() == 1}


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark, docs, empty):
    rows = docs.collect()
    prints = [slow_fingerprint(r.text) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for r, g in zip(rows, group):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    expected = sorted(((r.doc_id, f, least.get(g)) for r, f, g in zip(rows, prints, group)), key=repr)
    for heavy in (1, 256):
        got = simhash.near_duplicates(docs, heavy=heavy).collect()
        assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == expected
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(group))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(least.values()))


def test_suffix_array_is_sorted():
    rng = random.Random(1)
    for _ in range(2000):
        s = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 40))]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("kinds", [1, 1000])
def test_suffix_dedup(spark, docs, empty, kinds):
    """``kinds`` = 1 sends every group by the other way, window hashes."""
    rows = docs.collect()
    for size, gram in ((60, 16), (400, 64)):
        expected = sorted((-1 if r.doc_id is None else r.doc_id, *x) for r, x in zip(rows, suffix_dedup.brute_force([r.text for r in rows], size)))
        done = suffix_dedup.remove_repeats(docs, size, gram, carry=["kept", "runs"], group_kinds=kinds)
        assert done.columns[-2:] == ["_carry_kept", "runs"]
        got = [r[:] for r in done.collect()]
        import hashlib

        assert sorted((-1 if r[0] is None else r[0], *r[1:4], hashlib.sha256(bytes(r[5])).hexdigest()) for r in got) == expected
    assert suffix_dedup.remove_repeats(empty).count() == 0
    left = suffix_dedup.clean(docs, 60, 16)
    assert left.schema.names == docs.schema.names and left.count() == docs.count()


def test_substring_dedup(spark, docs, empty):
    import hashlib

    rows = docs.collect()
    for size, chunk in ((5, 1 << 19), (5, 64), (35, 1 << 19), (35, 300)):
        expected = sorted((-1 if r.doc_id is None else r.doc_id, *x) for r, x in zip(rows, substring_dedup.brute_force([r.text for r in rows], size)))
        got = substring_dedup.remove_repeats(docs, size, chunk=chunk).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got) == expected
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_suffix_dedup_of_words(spark, docs):
    rows = docs.collect()
    for size, gram in ((5, 2), (45, 8)):
        expected = sorted((-1 if r.doc_id is None else r.doc_id, x[2]) for r, x in zip(rows, substring_dedup.brute_force([r.text for r in rows], size)))
        out = suffix_dedup.clean(docs, size, gram, "word")
        import hashlib

        assert out.schema == docs.schema
        assert sorted((-1 if r.doc_id is None else r.doc_id, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) for r in out.collect()) == expected


def test_every_window_is_counted_once(spark, docs):
    """Each window of each text is hashed; a window that a chunk has twice is sent from it once."""
    hashed = substring_dedup.hash_windows(windows.keyed(docs), 5, 16, 1 << 19).collect()
    sent = sum(len(r.hashes) // 8 for r in hashed if r.hashes is not None)
    per_chunk = {}
    for r in hashed:
        if r.docs is not None:
            per_chunk[r.chunk] = (sum(d.words - 4 for d in r.docs), len(r.places) // 4)
    total = sum(len(w) - 4 for w in ((r.text or "").split() for r in docs.collect()) if len(w) >= 5)
    assert sum(n for n, _ in per_chunk.values()) == total
    assert total - sum(n for _, n in per_chunk.values()) <= sent < total


def test_hashes_that_agree_in_part():
    """64 bits decide together with 16 others."""
    def row(chunk, hashes, tags):
        places = np.arange(len(hashes), dtype="<u2")
        return chunk, 0, None, np.array(hashes, "<u8").tobytes(), np.array(tags, "<u2").tobytes(), places.tobytes() + np.zeros(len(hashes), "<u2").tobytes()

    got = substring_dedup._repeated_places([row(1, [7, 9, 5], [1, 1, 1]), row(2, [7, 9], [2, 1]), row(3, [7], [1])])
    assert {c: np.frombuffer(p, "<u4").tolist() for c, _, p in got} == {1: [0, 1], 2: [1], 3: [0]}


def test_segments_cover_all_windows():
    rng = np.random.default_rng(3)
    for n in (35, 36, 100, 700):
        codes = rng.integers(0, 3, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        anchor, _, _, first, count = windows.segments(codes, 35, 8)
        assert first[0] == 0 and count.sum() == n - 34 and (first[1:] == (first + count)[:-1]).all()
    assert windows.segments(codes[:34], 35, 8) is None
    _, one, _, first, count = windows.segments(codes, 35, 8, piece=100)
    assert first[0] == 0 and count.sum() == n - 34 and (first[1:] == (first + count)[:-1]).all()


def test_hashes_of_a_piece():
    """A piece of a text has the hashes that it has within the whole."""
    text = " ".join(random.Random(5).choice("abc") for _ in range(3000))
    codes = substring_dedup.codes_of_words(text)
    whole = windows.Hashes(codes)
    for at in (0, 100, 2900):
        part = windows.Hashes(codes[at : at + 60])
        assert (part.every(35) == whole.every(35)[at : at + 26]).all()


def test_decontamination(spark, docs, empty):
    texts = [r.text for r in docs.where("length(text) > 500").limit(3).collect()]
    words = [decontamination_words(t) for t in texts]
    items = [(1, " ".join(words[0][5:40])), (2, " ".join(words[1][3:7])), (2, "nowhere " * 12), (30, " ".join(words[0][5:40]).upper()), (4, None), (5, ""), (6, "one"), (7, "!!"), (None, "two three")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.report(docs, table).collect()
    rows = docs.collect()
    expected = []
    for r in rows:
        w = decontamination_words(r.text)
        hit, named = set(), set()
        for item, text in items:
            v = decontamination_words(text)
            n = min(10, len(v))
            for i in range(len(v) - n + 1 if v else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[i : i + n]:
                        hit.update(range(j, j + n))
                        named.add(item)
        expected.append((-1 if r.doc_id is None else r.doc_id, len(w), len(hit), sorted(str(x) for x in named if x is not None), bool(hit)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, list(r.items), r.contaminated) for r in got) == sorted(expected)
    assert sum(x[-1] for x in expected) > 3
    assert decontamination.clean(docs, table).count() == sum(not x[-1] for x in expected)
    assert decontamination.report(empty, table).count() == 0
    assert decontamination.report(docs, table.limit(0)).where("contaminated").count() == 0


def decontamination_words(text):
    import re

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_html_extraction(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header><h1>Site</h1></header>
    <nav><ul><li><a href=x>Home</a></ul></nav><div class="ad">Buy now, friends.</div><article><h1>Head &amp; more</h1><p><b>First  line,
    with marks.<br><p>Second&nbsp;one; longer than the others are, by far.<form><p>Name, please?</form><ul><li>A point.<li>Another.</ul>
    <div class="comments"><p>I, a reader, think this is long, and say so; at length.</div></article><aside>Side, side.</aside><footer>&copy; x</footer>"""
    expected = "Head & more\nFirst line, with marks.\nSecond one; longer than the others are, by far.\nA point.\nAnother."
    assert html_extract.extract(page) == expected
    plain = page.replace("article", "div")
    assert html_extract.extract(plain) == expected
    for odd in ("", " ", "<", "<p", "<!--", "a<b c", "<script>x", "</p></p>", "<p>" * 3000, "&#0;&bogus;&amp", "<a href='", '<p title="a>b">x</p>'):
        html_extract.extract(odd)
    assert html_extract.extract('<p title="a>b">x</p>') == "x"
    rows = [(1, "u", page, "t", 3), (1, "u", page, "t", 3), (None, None, None, None, None), (2, "v", "", "t", 0)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = html_extract.main_text(frame).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, expected, len(expected)), (1, expected, len(expected)), (2, "", 0)]
    assert html_extract.main_text(frame.limit(0)).count() == 0


def test_path_scores_by_hand():
    """Aggregate, smooth, fuse and threshold, written out plainly."""
    import math
    import statistics

    rng = random.Random(9)
    for _ in range(40):
        paths = [("html", "body"), ("html", "body", "div"), ("html", "body", "div", "p"), ("html", "body", "ul", "li")]
        found = []
        for _ in range(rng.randint(1, 12)):
            text = "".join(rng.choice("ab ,.") for _ in range(rng.randint(1, 60)))
            found.append(html_extract.Block(rng.choice(paths), text, rng.choice([0, 0, len(text), 3]), False))
        char, mark = {}, {}
        for p in {b.path for b in found}:
            own = [b for b in found if b.path == p]
            char[p] = sum(max(0, len(b.text) - b.links) for b in own) / len(own)
            mark[p] = sum(sum(c in ",." for c in b.text) for b in own if b.links < len(b.text)) / len(own)
        expected = {}
        for p in char:
            fused = []
            for i, b in enumerate(found):
                if b.path == p:
                    near = {j: math.exp(-((i - j) ** 2) / 2) for j in range(len(found)) if abs(i - j) <= 2}
                    c, m = (sum(w * of[found[j].path] for j, w in near.items()) / sum(near.values()) for of in (char, mark))
                    fused.append(c * (1 + m))
            expected[p] = sum(fused) / len(fused)
        scores = html_extract.path_scores(found)
        assert scores == pytest.approx(expected)
        limit = statistics.pstdev(expected.values())
        chosen = html_extract.content_paths(scores)
        top = max(expected.values())
        assert expected[chosen[0]] == pytest.approx(top)
        assert all(abs(expected[p] - limit) < 1e-9 or (p in chosen) == (expected[p] >= limit or p == chosen[0]) for p in expected)
        node = html_extract.container(found, scores)
        held = [0] if not chosen[0] else [sum(scores[b.path] for b in found if b.path in chosen and len(b.path) > k and b.path[:k] == chosen[0][:k]) for k in range(len(chosen[0]))]
        assert node == chosen[0][: len(node)] and (held[len(node)] >= html_extract.HOLD * held[0] - 1e-9) and all(h < html_extract.HOLD * held[0] + 1e-9 for h in held[len(node) + 1 :])


def test_scores_choose_the_node():
    page = "<body><div class=teaser>Read this now, all of you.</div><div><h1>Head</h1><p>Much more text, and longer; with marks of all kinds, as articles have. So it goes on.</p><p>Again a long one, as before, and the end.</p></div><section>Contact us</section>"
    article = "Head\nMuch more text, and longer; with marks of all kinds, as articles have. So it goes on.\nAgain a long one, as before, and the end."
    assert html_extract.extract(page) == article


def edits(a, b):
    """Least number of insertions, deletions, substitutions and swaps of neighbours (each place edited once)."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automata_agree_with_edit_distance():
    rng = random.Random(6)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(4, 7))) for _ in range(12)})
    trie = toxicity.Trie(terms)
    for _ in range(3000):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(3, 8)))
        near = min((edits(t, word), t) for t in terms)
        assert trie.near(word, 1) == ((near[1], near[0]) if near[0] <= 1 else None)
        assert trie.near(word, 0) == ((word, 0) if word in terms else None)


def test_lexicon_and_context():
    lexicon = toxicity.Lexicon({"idiot": 1.0, "scum": 1.0, "lowei*": 1.0}, frozenset(["idiom"]))
    found = {w: lexicon.find(w) for w in ("Idiot!", "id1ot", "idoit", "idiots", "idiom", "scum", "scums", "loweischaft", "lowe", "***", "")}
    assert found == {"Idiot!": ("idiot", 0), "id1ot": ("idiot", 1), "idoit": ("idiot", 1), "idiots": ("idiot", 1), "idiom": None, "scum": ("scum", 0), "scums": None, "loweischaft": ("lowei*", 0), "lowe": None, "***": None, "": None}
    abuse = toxicity.abuse("you are an idiot and scum", lexicon)[0]
    quoted = toxicity.abuse('the word "idiot" is an insult, the report said; so is the term "scum"', lexicon)[0]
    assert abuse == 2.0 and quoted < 0.5
    assert toxicity.abuse(None, lexicon) == toxicity.abuse("", lexicon) == (0.0, 0, 0, 0.0)


def test_toxicity_on_held_out_rows(spark):
    from tesserae.llm.common import table

    sf = "/root/testdata/sf0.1"
    rows = toxicity.query(spark, sf).join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 for r in rows)
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    caught = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    assert right > 0.97 and caught > 0.85


def misspelt(rng, raw):
    """``raw`` with one letter changed, left out, doubled or swapped, past its first."""
    letters = [i for i, c in enumerate(raw) if c.isalpha()][1:]
    i = rng.choice(letters[:-1])
    return rng.choice([raw[:i] + rng.choice("xqz0*") + raw[i + 1 :], raw[:i] + raw[i + 1 :], raw[:i] + raw[i] + raw[i:], raw[:i] + raw[i + 1] + raw[i] + raw[i + 2 :]])


def test_automata_and_context_help(spark):
    """Held-out rows, toxic ones with every term misspelled, and clean ones that quote terms: with the automata and the
    quotation scores, and without either."""
    from tesserae.llm.common import table

    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    lexicon, beta = toxicity.learn(toxicity.sample(docs, labels))
    held = docs.join(labels, "doc_id").where(toxicity.held_out() & F.col("toxic").isNotNull()).select("doc_id", "text", "toxic").collect()
    without = toxicity.Lexicon(lexicon.weights, lexicon.innocent, frozenset(lexicon.words))

    def flagged(text, own, context=True):
        found = own.hits(text) if text else []
        words = (text or "").split()
        x = sum(own.weights[t] * (toxicity.FUZZY if e else 1) * (1 - (1 - toxicity.QUOTED) * (toxicity.quotation(words, at) if context else 0)) for at, t, e in found)
        return beta[0] + beta[1] * np.log1p(x) >= 0

    rng = random.Random(7)
    terms = [t for t in lexicon.words if len(t) >= 5 and t not in lexicon.strict and t.isascii()]
    assert len(terms) >= 8
    wrong, quoted = [], []
    for r in held:
        words = (r.text or "").split()
        hits = without.hits(r.text) if r.text else []
        if r.toxic and hits and all(t in terms for _, t, _ in hits):
            for at, _, _ in hits:
                words[at] = misspelt(rng, words[at])
            wrong.append(" ".join(words))
        if not r.toxic and not hits and words:
            a, b = rng.sample(terms, 2)
            at = rng.randrange(len(words))
            quoted.append(" ".join([*words[:at], f'the word "{a}" is an insult, the report said; so is the term "{b}", it said.', *words[at:]]))
    assert len(wrong) >= 15 and len(quoted) > 100

    def share(texts, *options):
        return sum(flagged(t, *options) for t in texts) / len(texts)

    assert share(wrong, lexicon) > 0.8 and share(wrong, without) < 0.2
    assert share(quoted, lexicon) < 0.02 and share(quoted, lexicon, False) > 0.9
    # and on the held-out rows as they are nothing is lost by either
    plain = [(flagged(r.text, lexicon), flagged(r.text, without), flagged(r.text, lexicon, False), r.toxic) for r in held]
    assert sum(a == y for a, _, _, y in plain) >= max(sum(b == y for _, b, _, y in plain), sum(c == y for _, _, c, y in plain))


def test_toxicity_edges(spark, docs, empty):
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    lexicon, beta = toxicity.learn(toxicity.sample(docs, labels))
    rows = toxicity.score(docs, lexicon, beta, carry=["doc_id", "text"]).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(empty, lexicon, beta).count() == 0
    nothing = toxicity.learn(toxicity.sample(docs, labels.limit(0)))
    assert len({r.score for r in toxicity.score(docs, *nothing).collect()}) == 1
