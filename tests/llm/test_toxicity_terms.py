"""Terms of few contexts among very many others."""

import random

from tesserae.llm import toxicity


def test_rare_term_among_many(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklm", k=10)) for _ in range(4500)]

    def texts(n):
        every = [w for _ in range(6) for w in rng.sample(words, len(words))]
        return [every[k::n] for k in range(n)]

    toxic, other = texts(40), texts(200)
    for k in range(10):
        toxic[k] += ["pq", "zyxwvu", f"rs{k % 4}"]
    rows = spark.createDataFrame([(" ".join(t), 1) for t in toxic] + [(" ".join(t), 0) for t in other], "text string, toxic int")
    lexicon, _ = toxicity.learn(rows)
    assert lexicon.find("zyxwvu") == ("zyxwvu", 0)
    assert set(lexicon.weights) == {"zyxwvu"}
