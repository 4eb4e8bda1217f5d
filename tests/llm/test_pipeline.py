"""The stages, one by one, against brute force."""

import hashlib
import random
import zlib

import corpus_pipeline
from pyspark.sql import types as T
from tesserae.llm import substring_dedup
from tesserae.llm.encode import Encoder, default_path
from test_llm_operators import corpus, decontamination_words
from test_near_copies import least_of_components

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_dedup", "passage_dedup", "decontaminate", "pack"]

    kept = stages["quality_rules"](spark, docs, SF).cache()
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()

    single = stages["near_dedup"](spark, kept, SF).cache()
    rows = kept.collect()
    assert sorted(r.doc_id for r in single.collect()) == least_of_components([(r.doc_id, r.text) for r in rows])

    cut = stages["passage_dedup"](spark, single, SF).cache()
    rows = single.collect()
    texts = {r.doc_id: r.text for r in rows}
    expected = dict(zip(texts, substring_dedup.brute_force(list(texts.values()), 45)))
    assert cut.columns == docs.columns and cut.count() == len(rows)
    for r in cut.collect():
        _, gone, kept = expected[r.doc_id]
        assert r.n_chars == len(r.text) and (gone > 0) == (r.text != texts[r.doc_id])
        assert hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest() == kept
    assert any(gone for _, gone, _ in expected.values())

    clean = stages["decontaminate"](spark, cut, SF).cache()
    items = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = decontamination_words(r.text)
        n = min(10, len(w))
        items |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1) if w}
    sizes = {len(i) for i in items}
    expected = []
    for r in cut.collect():
        w = decontamination_words(r.text)
        if not any(tuple(w[i : i + n]) in items for n in sizes for i in range(len(w) - n + 1)):
            expected.append(r.doc_id)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(expected)

    pieces = stages["pack"](spark, clean, SF).collect()
    enc = Encoder(default_path("byte_bpe_50k.json"))
    texts = {r.doc_id: enc.encode(r.text) + (1).to_bytes(4, "little") for r in clean.collect()}
    assert sum(r.length for r in pieces) == sum(len(x) // 4 for x in texts.values())
    for r in pieces:
        assert r.ids_crc32 == zlib.crc32(texts[r.doc_id][4 * r.start : 4 * (r.start + r.length)])

    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in pieces)


def test_passages_of_over_fifty_words_go(spark):
    """Passages of 51 words and more in two texts each, short words and long, between words of their own."""
    rng = random.Random(6)
    own = iter(range(1_000_000))
    texts, passages = [], []
    for k in range(12):
        passage = [f"{rng.choice('abcdefgh') * (1 + k % 6)}{rng.randrange(300)}" for _ in range(51 + k)]
        passages.append(" ".join(passage))
        for _ in range(2):
            words = [f"w{next(own)}" for _ in range(80)]
            at = rng.randrange(80)
            texts.append(" ".join([*words[:at], *passage, *words[at:]]))
    clean_text = " \n".join(f"w{next(own)}" for _ in range(200))
    docs = spark.createDataFrame([(k, t, "x", len(t)) for k, t in enumerate([*texts, clean_text])], "doc_id long, text string, source string, n_chars long")
    rows = {r.doc_id: r.text for r in corpus_pipeline.passage_dedup(spark, docs, "").collect()}
    assert rows[len(texts)] == clean_text
    for k in range(len(texts)):
        assert passages[k // 2] in texts[k] and len(rows[k].split()) == 80


#: Names that the operators use themselves, and awkward ones.
ODD = ["other_0", "other_1", "new_text", "new_chars", "_carry_new_text", "carry_0", "in_0", "kept", "runs", "spans", "_doc", "_hash", "_key", "fp", "text_hash", "ratio", "component_id", "a.b", "back`tick", "start", "sequence_id", "ids"]


def test_stages_on_odd_tables(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing names, and no rows at all."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), *(T.StructField(n, T.StringType()) for n in ODD)])
    texts = [*corpus(n=12), " ".join(f"w{k % 977}" for k in range(120_000))]
    rows = [(None if k in (3, 9) else k, t, None if k == 5 else len(t or ""), *(None if k % 2 else f"{n}{k}" for n in ODD)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[8], rows[8]], schema)
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            found = out.collect()
            if name == "pack":
                assert {r.doc_id for r in found} == {r.doc_id for r in frame.collect()}
                continue
            assert out.schema.names == schema.names and (found or frame is not docs)
            whole = {(r.doc_id, tuple(r[n] for n in ODD)) for r in frame.collect()}
            assert all((r.doc_id, tuple(r[n] for n in ODD)) in whole for r in found)
            if name == "passage_dedup":
                assert len(found) == frame.count()
