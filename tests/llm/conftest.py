import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _salt int, label string, node long, "
          "shard int, words array<string>, _mix int, _copies int, start int")


def edge_rows(seed=1, n=60):
    """Texts with shared passages, near and exact copies, ties, nulls, empty
    and very long texts, and columns whose names operators use inside."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["été", "Straße", "the", "of"]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    texts = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))]
        if i % 5 == 0:
            words[len(words) // 2: len(words) // 2] = passage[: 50 + i % 21]
        if i % 7 == 0:
            words = list(base)
            words[rng.randrange(120)] = "changed"
        texts.append(" ".join(words))
    texts += [texts[3], texts[3], " ".join(base), "\t".join(base), None, "", " \n ", "x", "ÀÉ 123", "!!!", " ".join(vocabulary * 60)]
    rows = [(i, t, "en" if i % 3 else None, None if i % 11 == 0 else f"s{i % 4}", 0, 1, "l", 5, 2, ["a"], 1, 2, 3)
            for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[5], None, None, None, None, None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
