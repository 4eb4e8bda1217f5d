"""The near-duplicate stage of the pipeline against brute force."""

import random

import corpus_pipeline
from pyspark.sql import functions as F
from tesserae.llm import near_copies, simhash


def jaccard(a, b):
    sets = []
    for text in (a, b):
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else {()})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def least_of_components(rows):
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and jaccard(rows[i][1], rows[j][1]) >= 0.8:
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for (doc, _), g in zip(rows, group):
        least[g] = min(least.get(g, doc), doc)
    return sorted(least.values())


def test_planted_near_copies(spark):
    rng = random.Random(3)
    some = [f"word{k}" for k in range(500)]
    texts = [None, "", "  ", "a few words", "A  few words", "a few other words", "a a a a a a", "a a a a a"]
    for n in (60, 100, 300, 800):
        for _ in range(4):
            base = rng.choices(some, k=n)
            texts.append(" ".join(base))
            for share in (0.005, 0.015, 0.02, 0.025, 0.03):
                texts.append(" ".join(rng.choice(some) if rng.random() < share else w for w in base))
    # nine shingles, of which another text of eight has all: over 0.8; and one word in the middle of 45: exactly 0.8 apart
    texts += ["p q r s t u v w x y z l m", "p q r s t u v w x y z l", " ".join(some[:49]), " ".join([*some[:22], "new", *some[23:49]])]
    line = " ".join(some[:12])
    texts += [line + " " + " ".join(rng.choices(some, k=80)) for _ in range(20)]
    hub = rng.choices(some, k=120)
    texts += [" ".join([*hub[:k], "changed", *hub[k + 1 :]]) for k in range(3, 117, 2)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = least_of_components(rows)
    out = corpus_pipeline.near_dedup(spark, docs, "")
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == expected
    assert len(expected) < simhash.keep_one(docs).count()  # prints at most four bits apart leave some
    assert near_copies.keep_one(docs.limit(0)).count() == 0


def test_documents_without_ids(spark):
    docs = spark.createDataFrame([(None, "one two three"), (None, "one two three"), (None, "four"), (7, "ONE two three"), (7, "ONE two three")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in near_copies.keep_one(docs).collect() if r.doc_id) == [(7, "ONE two three")]
    assert near_copies.keep_one(docs).count() == 2


def test_near_copies_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == least_of_components(rows)


def test_prints_propose_pairs_that_shingles_decide(spark, monkeypatch):
    """Without any band, texts whose prints are alike are linked if their shingles are similar, and only then."""
    rng = random.Random(5)
    base = [f"word{rng.randrange(500)}" for _ in range(600)]
    often = [f"often{k}" for k in range(7)] * 200
    texts = [" ".join(base), " ".join([*base[:-1], "end"]), " ".join([*often, "one", "two", "three"]), " ".join([*often, "four", "five", "six"]), "some other text of nine words, not of ten"]
    assert bin((simhash.fingerprint(texts[2], 5) ^ simhash.fingerprint(texts[3], 5)) % 2**64).count("1") <= near_copies.PRINT_BITS
    assert jaccard(texts[0], texts[1]) > 0.8 > jaccard(texts[2], texts[3])
    whole = near_copies.prints
    monkeypatch.setattr(near_copies, "prints", lambda docs: whole(docs).withColumn("keys", F.array().cast("array<long>")))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [0, 2, 3, 4]
