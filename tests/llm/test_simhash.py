import itertools
import random

import numpy as np
import xxhash

from pricetrend.llm import simhash
from pricetrend.llm.graph import components


def plain_fingerprint(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, distance=4):
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (rows[i][1] ^ rows[j][1]).bit_count() <= distance:
            root[find(i)] = find(j)
    return [min((rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None), default=None)
            for i in range(len(rows))]


def test_fingerprint_matches_the_definition():
    random.seed(1)
    texts = ["", None, " \t\n", "One", "ÀB two three", "a b c d", "a b c d e\x85f\xa0g"] + [
        " ".join(random.choice("abcdefgh") * random.randint(1, 4) for _ in range(random.randint(1, 90))) for _ in range(60)]
    for t in texts:
        assert simhash.fingerprint(t, 4) & (2 ** 64 - 1) == plain_fingerprint(t)


def test_sections_change_nothing(monkeypatch):
    random.seed(7)
    monkeypatch.setattr(simhash, "SECTION", 9)
    for n in [*range(12), 40, 200]:
        for sep in (" ", "\n", "   "):
            t = sep.join(random.choice(["a", "bb", "CCCCCCCCCCCCCCC", "d"]) for _ in range(n))
            assert simhash.fingerprint(t, 4) & (2 ** 64 - 1) == plain_fingerprint(t), t
    for t in ("a bb" + " " * 40 + "c", " " * 30 + "a b c", "a b c d" + " " * 50, "a" * 40 + " b"):
        assert simhash.fingerprint(t, 4) & (2 ** 64 - 1) == plain_fingerprint(t), t


def test_collisions_find_every_pair_within_the_radius():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2 ** 64, 30, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, n, replace=False))) for b in base for n in (1, 2, 3, 4, 5)]
    fps = np.unique(np.concatenate([base, np.array(near, np.uint64)]))
    for at_once in (10 ** 9, 50_000):
        a, b = simhash.collisions(fps, np.full(len(fps), 2), 64, at_once)
        a, b = simhash.forest(len(fps), a, b)
        got = {frozenset(x) for x in _groups(len(fps), a, b)}
        i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
        assert got == {frozenset(x) for x in _groups(len(fps), i, j)}


def _groups(n, a, b):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in zip(a, b):
        root[find(int(i))] = find(int(j))
    out = {}
    for i in range(n):
        out.setdefault(find(i), []).append(i)
    return out.values()


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(7, 7)]
    random.seed(3)
    random.shuffle(edges)
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 80)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_against_brute_force(spark):
    random.seed(4)
    words = ["w%d" % i for i in range(400)]
    texts = []
    for _ in range(25):
        t = [random.choice(words) for _ in range(300)]
        texts.append(" ".join(t))
        for changed in (1, 1, 2, 6):
            u = list(t)
            for _ in range(changed):
                u[random.randrange(300)] = random.choice(words)
            texts.append(" ".join(u).upper())
    rows = list(enumerate(texts)) + [(900, ""), (901, None), (902, "\n"), (3, texts[3]), (None, texts[0]), (None, "alone in the world")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", __import__("pyspark").sql.functions.lit("clash"))
    got = simhash.near_duplicates(df).collect()
    want = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    key = lambda x: (x[0] is None, x[0] or 0, x[1], str(x[2]))
    assert sorted(((r["doc_id"], r["fingerprint"] & (2 ** 64 - 1), r["component_id"]) for r in got), key=key) == sorted(
        ((i, plain_fingerprint(t), c) for (i, t), c in zip(rows, want)), key=key)
    kept = simhash.keep_one(df).collect()
    ids = sorted(r["doc_id"] for r in kept if r["doc_id"] is not None)
    assert ids == sorted({c for c in want if c is not None})
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["alone in the world"]
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def test_keep_one_of_repeated_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (5, "quite another text with words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS kept_id", "'y' AS its_id")
    got = simhash.keep_one(df).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 5] and got[0].asDict().keys() == {"doc_id", "text", "kept_id", "its_id"}
