"""Near duplicates: ids that floats cannot hold, and crowded groups, against brute force."""

import random
import re
import time

from pyspark.sql import functions as F

from clusterlens.llm import jaccard_join
from clusterlens.llm.common import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """(doc_id, n_shingles, component_id) of every row, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(k):
        while comp[k] != k:
            comp[k] = comp[comp[k]]
            k = comp[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 3 * max(len(sets[a]), len(sets[b])) <= 4 * min(len(sets[a]), len(sets[b])) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                comp[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def found(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, node int, comp string").repartition(4)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(df).collect()), key=str)


def edited(rng, words, share):
    return " ".join(f"x{rng.randrange(999)}" if rng.random() < share else w for w in words)


def test_ids_beyond_floats_beside_nulls(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(500)}" for _ in range(120)]
    big = (1 << 60) + 1
    rows = [(big, " ".join(words)), (big + 1, " ".join(words) + " end"), (big + 2, "other text of its own that links with nothing"), (None, " ".join(words)), (None, "a null of its own, five words or more"), (-big, "")]
    assert found(spark, rows) == brute(rows)


def test_crowded_groups_lose_no_link_and_add_none(spark):
    """Near copies of one text that hold a third of all rows: edits of 1 to 4 words in 100, so that some link only through others and some with nobody."""
    rng = random.Random(2)
    base = [[f"w{rng.randrange(900)}" for _ in range(150)] for _ in range(2)]
    rows = [(k, edited(rng, base[0], rng.choice([0.01, 0.02, 0.03, 0.04]))) for k in range(260)]
    rows += [(1000 + k, edited(rng, base[1], 0.025)) for k in range(90)]
    passage = " ".join(base[0][20:80])
    rows += [(2000 + k, passage + " " + " ".join(f"v{rng.randrange(10_000)}" for _ in range(rng.randrange(5, 60)))) for k in range(150)]  # one passage that many share
    rows += [(3000 + k, " ".join(f"u{rng.randrange(10_000)}" for _ in range(60))) for k in range(300)]
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows) - 200  # many do link
    assert found(spark, rows) == want


def test_duplicates_go_by_id_and_text(spark):
    rng = random.Random(4)
    a, b, c = ([f"{x}{rng.randrange(500)}" for _ in range(100)] for x in "abc")
    near = lambda w, k: " ".join([*w[:-1], f"end{k}"])
    rows = [(5, near(a, 0), "x"), (3, near(a, 1), "x"), (5, "a text of its own under a repeated id", "x"), (None, near(a, 2), "x"), (7, near(b, 0), "x"), (7, near(b, 1), "y"),
            (None, near(c, 0), "z"), (None, near(c, 1), "z"), (None, near(c, 2), "z"), (None, None, "n"), (9, "", "n"), (9, None, "n"), (2, "x", "s"), (2, "x", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_key string").repartition(3)
    kept = [tuple(r) for r in jaccard_join.drop_near_duplicates(docs).collect()]
    assert {r for r in kept if r[1] in (near(a, 0), near(a, 1), near(a, 2))} == {(3, near(a, 1), "x")}
    assert len([r for r in kept if r[0] == 7]) == 1 and len([r for r in kept if r[2] == "z"]) == 1
    assert (5, "a text of its own under a repeated id", "x") in kept and len([r for r in kept if r[2] == "n"]) == 3 and len([r for r in kept if r[2] == "s"]) == 2
    assert jaccard_join.drop_near_duplicates(docs.limit(0)).count() == 0


def test_tokens_indexed_alone_are_not_crowded_in_large_corpora():
    """What more documents share makes families, whose blocks grow with the square of their nodes: three million documents need none for single tokens."""
    assert jaccard_join.least_frequency(3_100_000) <= jaccard_join.CROWDED


def test_stored_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {n for n in disk.getAllBlocks().mkString(" ").split() if n.startswith("shuffle_")}
    before = files()
    kept = stored(spark.range(50_000).groupBy((F.col("id") % 97).alias("k")).count(), "test-stored")
    until = time.monotonic() + 20  # files are removed beside the work
    while files() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not files() - before
    assert sorted(r["k"] for r in kept.collect()) == list(range(97))
