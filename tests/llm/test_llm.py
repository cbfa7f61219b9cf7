"""The training-data operators against brute force, on small tables with awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from clusterlens.llm import byte_bpe, exact_dedup, html_extract, jaccard_join, latent_vote, mixing, queries, rule_forest, toxicity, url_filter, wavelet_tokens
from clusterlens.llm.common import words_of

WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, sig long, `__h` long"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "river", "stone", "light", "garden", "paper", "music", "quiet", "Morning,"]) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = [prose(rng, rng.randrange(8, 90)) for _ in range(60)]
    near = [" ".join(w if rng.random() > p else "x%d" % rng.randrange(99) for w in base[k].split()) for k in range(6) for p in (0.02, 0.03, 0.05, 0.06, 0.08)]
    long = prose(rng, 30_000)
    odd = [None, "", "   \n\t ", "one", "ONE", "two words", "a  b\tc", "a b c", "\u00a0nbsp\u2003em É ß İ Σας", "<|endoftext|> it's 'S", "\n" * 5 + "x" + " " * 5000 + "y", "q" * 3000, "é" * 700]
    return [*base, *near, *base[:5], base[0].upper(), long, long + " end", *odd]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, "en", [None, "b", "a", "ä"][k % 4], 0, 0.5, 1, 2, 3) for k, t in enumerate(texts)]
    rows.append(rows[3])  # a repeated row
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_words_split_like_the_pattern(texts):
    own = words_of([(t or "").encode() for t in texts])
    for k, t in enumerate(texts):
        assert [own.distinct[c].decode() for c in own.of(k)] == re.findall(WORD, t or "")


# 1 and 10
@pytest.mark.parametrize("operator, label", [(latent_vote, "quality"), (toxicity, "toxic")])
def test_classifiers_learn_and_score_odd_rows(spark, docs, empty, operator, label):
    rng = random.Random(5)
    bad = {"quality": lambda t: " ".join(w + "%%%" for w in t.split()), "toxic": lambda t: t + " idiot scum"}[label]
    rows = []
    for k in range(400):
        t = prose(rng, 40) + (" women" if k % 3 == 0 else "")
        marked = k % 4 == 0
        rows.append((k, bad(t) if marked else t, int(marked if label == "toxic" else not marked)))
    own = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], None) for r in rows] + [(None, 1, None), (7, None, None)], f"doc_id long, {label} int, text string")
    model = operator.train(own, labels, label)
    got = {r["doc_id"]: r["s"] for r in own.select("doc_id", operator.score(F.col("text"), model).alias("s")).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum((got[i] >= 0.5) == bool(y) for i, _, y in held) >= 0.95 * len(held) and len(held) > 50
    odd = docs.select("doc_id", "text", operator.score(F.col("text"), model).alias("s")).collect()
    assert all(0 <= r["s"] <= 1 for r in odd) and len(odd) == docs.count()
    assert len({r["s"] for r in odd if not (r["text"] or "").strip()}) == 1
    assert empty.select(operator.score(F.col("text"), model)).count() == 0
    assert operator.train(empty, labels.limit(0), label) is not None


def test_counterfactual_swaps_and_penalty():
    change = toxicity.swaps({"g": ["women", "men"]})
    assert toxicity.swap_terms("Women and men", change) == "men and women" and toxicity.swap_terms("none", change) is None
    texts = [f"women talk w{k}" for k in range(40)] + [f"men talk m{k}" for k in range(40)]
    own = toxicity.terms([t.encode() for t in texts])
    other = toxicity.terms([toxicity.swap_terms(t, change).encode() for t in texts])
    labels = np.array([1.0] * 40 + [0.0] * 40)  # biased labels: the penalty must hold the scores together
    delta = toxicity.difference(own, other, np.arange(80))
    gap = [abs(m.score(toxicity.terms([b"women"]))[0] - m.score(toxicity.terms([b"men"]))[0]) for m in (toxicity.fit(own, labels, delta, counterfactual=0.0), toxicity.fit(own, labels, delta, counterfactual=5.0))]
    assert gap[1] < 0.5 * gap[0]


# 2
def test_url_filter(spark):
    urls = [None, "", "nohost", "http://A.Example.ORG/es/x?y#z", "https://example.org/en/12", "x://org", "x://org/", "x://notorg.com/fr/", "x://a.com?p/de/", "x://b.com/de/", "x://..org//", "http://example.org/en/2"]
    rows = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: (r["j"]["host"], r["j"]["path"], r["j"]["rule"], r["j"]["verdict"]) for r in rows.select("page_id", url_filter.judge_urls(spark, F.col("url"), queries.URL_RULES).alias("j")).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[4][2:] == ("example.org/en/1", "block") and got[5] == ("org", "", None, "allow") and got[6][2] == "org/"
    assert got[7][2:] == ("com/fr/", "allow") and got[8] == ("a.com", "", None, "allow") and got[9][3] == "block" and got[11][2] == "org/"


def test_url_digests_survive_collisions(tmp_path):
    url_filter.write_digests(str(tmp_path / "d"), queries.URL_RULES, hash_of=lambda s: len(s) % 2)
    found = url_filter.DigestArray(str(tmp_path / "d"), hash_of=lambda s: len(s) % 2).judge(["http://example.org/es/", "http://x.net/"])
    assert found["rule"].tolist() == ["example.org/es/", None]


# 3
def brute_rules(t):
    t = t or ""
    w = re.findall(WORD, t)
    c = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    cover = {j for k in range(len(w) - 7) if c[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    return [len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(cover)]


def test_rule_counts_against_brute_force(spark, texts, docs):
    more = [*texts, "a b c d e f g h\n" * 3 + "z", "x " * 9, "# | <a> 100%\n\n# | <a> 100%"]
    found = rule_forest.statistics([(t or "").encode() for t in more])
    assert found[rule_forest.COUNTS].to_numpy().tolist() == [brute_rules(t) for t in more]
    labels = spark.createDataFrame([(k, 1) for k in range(60)], "doc_id long, quality int")
    forest = rule_forest.train(docs, labels)
    rows = docs.select("text", rule_forest.judge(F.col("text"), forest).alias("j")).collect()
    for r in rows:
        n, _, _, _, rep = brute_rules(r["text"])
        assert r["j"]["base_failed"] == (n < 20 or 100 * rep > 30 * n) and not (r["j"]["base_failed"] and r["j"]["kept"])
    assert rule_forest.train(docs, labels.limit(0)).score(np.zeros((2, len(rule_forest.FEATURES)))).tolist() == [0, 0]


# 4
def test_byte_bpe(spark, docs, texts, empty):
    own = byte_bpe.Coder(RANKS, public_tokenizers.PATTERN, chunk=50)
    for t in texts:
        if t and len(t) < 10_000 and "  " * 900 not in t:
            assert own.encode(t).tolist() == own.encoding.encode_ordinary(t)
    rows = docs.select("text", byte_bpe.round_trip(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("t")).collect()
    assert all(bytes(r["t"]["decoded"]).decode() == (r["text"] or "") for r in rows)
    huge = "a" + " " * 1_200_000 + "b"  # the library alone fails here
    assert own.decode(own.encode(huge)).decode() == huge
    assert empty.select(byte_bpe.encode(F.col("text"), RANKS, public_tokenizers.PATTERN)).count() == 0


# 5
def test_exact_dedup(docs, texts, empty):
    groups = {}
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for k, t in [*enumerate(texts), (3, texts[3])]:
        groups.setdefault(norm(t), []).append(k)
    found = exact_dedup.duplicate_groups(docs)
    rows = exact_dedup.mark(docs, found).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        own = groups[norm(texts[r["doc_id"]])]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (min(own), len(own), r["doc_id"] == min(own))
        assert r["text_sha256"] == hashlib.sha256(norm(texts[r["doc_id"]]).encode()).hexdigest()
    left = exact_dedup.drop_duplicates(docs, found)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == sorted(min(g) for g in groups.values())
    assert exact_dedup.mark(empty, exact_dedup.duplicate_groups(empty)).count() == 0


def test_exact_dedup_of_null_ids(spark):
    rows = [(1, "one  copy with an id"), (None, "one copy with an id"), (None, "no id at all"), (None, "no id  at all"), (None, "no id at all"), (2, "alone"), (None, "alone, too"), (None, "")]
    own = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = exact_dedup.duplicate_groups(own)
    got = sorted((r["text_sha256"], r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"]) for r in exact_dedup.mark(own, found).collect())
    sha = lambda t: hashlib.sha256(re.sub(" +", " ", t).encode()).hexdigest()
    want = {"one copy with an id": (1, 2), "no id at all": (0, 3), "alone": (2, 1), "alone, too": (0, 1), "": (0, 1)}
    assert got == sorted((sha(t), i or 0, *want[re.sub(" +", " ", t)]) for i, t in rows)
    left = exact_dedup.drop_duplicates(own, found).collect()
    assert sorted((r["doc_id"] or 0, re.sub(" +", " ", r["text"])) for r in left) == sorted((k, t) for t, (k, _) in want.items())


# 6
def test_mixing(spark, docs, texts, empty):
    found = mixing.mix(docs, [3.0, 1.0, 2.0], 1.5, n_shards=5)
    rows = found.docs.collect()
    assert len(rows) == len(texts) + 1 and rows and sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs, [3.0, 1.0, 2.0], 1.5, n_shards=5).docs.collect()))
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r["size"] == len(re.findall(WORD, texts[r["doc_id"]] or "")) and r["copies"] <= 2
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    order = ["a", "b", "ä", None]
    want = mixing.targets(np.array([sizes[s] for s in order]), np.array([3.0, 1.0, 2.0, 3.0]), 1.5 * sum(sizes.values()))
    for s, w in zip(order, want, strict=True):
        assert abs(target[s] - w) < 1e-6 and abs(taken[s] - w) <= 100
    mixed = mixing.mixed_rows(docs, found, 5)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(i for r in rows for i in [r["doc_id"]] * r["copies"])
    assert mixing.mix(empty, [1.0], 1.5).docs.count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mixing_passes_over_long_documents(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.randrange(100, 700) for _ in range(500)] + [200_000]
    own = spark.createDataFrame([(k, "w " * n, "a") for k, n in enumerate(sizes)], "doc_id long, text string, source string").repartition(4)
    rows = mixing.mix(own, [1.0], 1.5, n_shards=3, seed=seed).docs.collect()
    assert len(rows) == 501 and {r["copies"] for r in rows} <= {1, 2}
    assert abs(sum(r["size"] * r["copies"] for r in rows) - 1.5 * sum(sizes)) <= 100


def test_mixing_of_ids_in_several_sources(spark):
    rows = [(i, f"{s} " * 10, s) for s in ("a", "b", None) for i in [*range(30), None, 5]]
    own = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = mixing.mix(own, [4.0, 1.0, 1.0], 1.2, n_shards=3)
    planned = Counter()
    for r in found.docs.collect():
        planned[r["doc_id"], r["source"]] += r["copies"]
    assert len(found.docs.select("copies").distinct().collect()) > 1
    mixed = mixing.mixed_rows(own, found, 3)
    assert Counter((r["doc_id"], r["source"]) for r in mixed.collect()) == +planned


def test_splitting_tree_is_exact():
    quotas = np.array([100, 7, 0, 33])
    deal = mixing.split_quotas(quotas, 6, np.random.default_rng(1))
    assert deal.sum(axis=0).tolist() == quotas.tolist() and np.ptp(deal.sum(axis=1)) <= 1 and deal.min() >= 0
    assert mixing.targets(np.array([10, 100, 100]), np.array([3.0, 1.0, 2.0]), 315.0).round(6).tolist() == [20, 98.333333, 196.666667]


# 7
def test_wavelet_files(spark, docs, texts, empty, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    manifest = wavelet_tokens.write_shards(docs, f"file://{tmp_path}/w", path, 2, n_parts=3, shard_ids=2000)
    assert manifest.count() > 3
    rows = sorted(wavelet_tokens.read_documents(manifest, f"file://{tmp_path}/w").collect(), key=lambda r: r["start"])
    at = 0
    for r, k in zip(rows, sorted([*range(len(texts)), 3]), strict=True):
        want = [*tokenizer.encode(texts[k] or "", add_special_tokens=False).ids, 2]
        assert r["doc_id"] == k and r["start"] == at and np.frombuffer(r["ids"], "<u4").tolist() == want
        at += len(want)
    assert wavelet_tokens.token_shards(empty, path, 2).count() == 0


def test_wavelet_access_count_occurrences():
    ids = np.random.default_rng(2).integers(0, 50, 3000).astype(np.uint32) ** 2
    own = wavelet_tokens.WaveletFile(wavelet_tokens.build_file([5, None], [1000, 2000], ids))
    assert own.doc_ids == [5, None] and own.starts.tolist() == [0, 1000, 3000] and (own.ids() == ids).all()
    assert [own.access(k) for k in (0, 17, 2999)] == ids[[0, 17, 2999]].tolist()
    for token in (0, 49, 2401, 7):
        assert own.occurrences(token).tolist() == np.flatnonzero(ids == token).tolist()
        assert own.count(token, 100, 2000) == (ids[100:2000] == token).sum()


# 8
def brute_components(texts, ids):
    low = lambda t: re.sub("[A-Z]+", lambda m: m.group().lower(), t or "")
    sets = {}
    for k, t in zip(ids, texts, strict=True):
        w = re.findall(WORD, low(t))
        sets[k] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    names = sorted(sets)
    for a in names:
        for b in names:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in names}


@pytest.mark.parametrize("frequent", [2, 6, 64])
def test_jaccard_join(spark, docs, texts, empty, frequent, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "FREQUENT_SHARE", 0)
    monkeypatch.setattr(jaccard_join, "FAMILY_BLOCK", 16)
    rng = random.Random(frequent)
    base = prose(rng, 150).split()
    family = [" ".join(w if rng.random() > rng.choice([0.005, 0.02, 0.05]) else f"y{rng.randrange(999)}" for w in base) for _ in range(90)]
    rows = [*enumerate([*texts, *family]), (3, texts[3])]
    got = jaccard_join.near_duplicates(spark.createDataFrame([*rows, (None, "only here"), (None, None)], "doc_id long, text string").repartition(4)).collect()
    want = brute_components([*texts, *family], range(len(texts) + len(family)))
    assert len(got) == len(rows) + 2
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want


def test_jaccard_join_empty(empty):
    assert jaccard_join.near_duplicates(empty).count() == 0


# 9
def test_minimum_cut_against_brute_force():
    import itertools

    rng = random.Random(4)
    for _ in range(150):
        n = rng.randint(1, 7)
        gains = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randint(0, 6)) for _ in range(rng.randint(0, 12))]
        value = lambda own: sum(g for g, x in zip(gains, own, strict=True) if x) - sum(c for a, b, c in edges if own[a] != own[b])  # noqa: B023, E731
        best = max(itertools.product([0, 1], repeat=n), key=lambda own: (value(own), -sum(own)))
        got = html_extract.minimum_cut(gains, edges)
        assert (value(got), sum(got)) == (value(best), sum(best))


def test_html_extract(spark):
    page = (
        "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a href=/x>Home</a></nav><div class=\"ad\">Buy</div><article><h1>A  &amp; B</h1>"
        "<p><b>First\n<br>line.<br><p>Second &lt;x&gt; caf&eacute;</p><div class='comments'><p>I liked it</p></div><aside>Aside</aside><form><p>mail</p></form></article>"
        "<div id=cookie-notice>We use cookies</div><footer>&copy; us</footer></body></html>"
    )
    rows = [(1, page), (2, None), (3, ""), (4, "plain < text"), (5, page[: page.index("Second") + 9]), (6, "<" * 3000), (7, page.replace("Second", "Second " * 50_000)), (1, page)]
    pages = spark.createDataFrame([(a, f"u{a}", b, "x") for a, b in rows], "page_id long, url string, html string, text string")
    weights = html_extract.train(pages)
    got = pages.select("page_id", html_extract.main_text(F.col("html"), weights).alias("m")).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["m"] for r in got}
    assert text[1] == "A & B\n\nFirst line.\n\nSecond <x> café" and text[2] == text[3] == "" and text[5] == "A & B\n\nFirst line.\n\nSecond <x"[: len("A & B\n\nFirst line.\n\nSecond")] + " &l"
    assert text[7].count("Second") == 50_000
    assert (html_extract.train(pages.limit(0)) == 0).all()


@pytest.fixture(scope="module")
def html_weights(spark):
    rng = random.Random(8)
    body = lambda: "".join(f"<p>{prose(rng, 30)}. {prose(rng, 20)}, {prose(rng, 9)}.</p>" for _ in range(4))
    rows = [(k, f"<nav><a href=/>{prose(rng, 2)}</a></nav><article><h1>{prose(rng, 4)}</h1>{body()}</article><footer>{prose(rng, 3)}</footer>") for k in range(40)]
    return html_extract.train(spark.createDataFrame(rows, "page_id long, html string"))


@pytest.mark.parametrize("page", [
    '<article class="post category-social">{}</article>',
    '<main class="content has-sidebar">{}</main>',
    '<div class="with-comments">{}</div>',
    '<div id="sidebar-left"><div><article>{}</article></div><aside>Aside</aside></div>',
    '<article><div class="entry social">{}</div></article>',
])
def test_html_words_of_wrappers_do_not_drop_the_text(html_weights, page):
    rng = random.Random(9)
    body = [f"{prose(rng, 30)}. {prose(rng, 20)}, {prose(rng, 9)}." for _ in range(4)]
    page = "<nav><a href=/>Home</a></nav>" + page.format("".join(f"<p>{t}</p>" for t in body)) + '<div class="ad">Buy now</div><footer>us</footer>'
    assert html_extract.extract_text(page, html_weights) == "\n\n".join(body)


def test_html_words_still_drop_small_parts(html_weights):
    rng = random.Random(10)
    body = [f"{prose(rng, 30)}. {prose(rng, 20)}, {prose(rng, 9)}." for _ in range(4)]
    page = '<article><header class="entry-header"><h1>The title</h1></header>' + "".join(f"<p>{t}</p>" for t in body) + '<div class="share"><a href=/>Share</a></div></article>'
    assert html_extract.extract_text(page, html_weights) == "\n\n".join(["The title", *body])


@pytest.mark.parametrize("part, left", [
    ("<datalist><option value=a><option value=b></datalist>", ""),
    ("<select><optgroup label=x><option>one<option>two</select>", ""),
    ("<p>Choose <select><option>one<option>two</select> now</p>", "Choose now"),
    ("<p>a<svg><path d='M0'/><title>icon</title><text>drawn</text></svg>b</p>", "ab"),
    ("<svg><g><path d=M0>", ""),
    ("<p>x</p><select><option>one", "x"),
    ("<template><article><p>never shown</p></article></template>", ""),
    ("<noscript><div><p>no script</p></div></noscript>", ""),
    ("<div><object data=x><p>fallback</div>", ""),
    ("<p>where <math><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow></math> holds</p>", "where x=2 holds"),
    (f"<p data-x='{'<b>>' * 3000}'>long</p>", "long"),
    (f'<p data-x="{"<b>>" * 3000}">long</p>', "long"),
    ("<p it's>one</p>", "one"),
    ("<p title=it's>one</p><p title = 'a>b'>two</p>", "one two"),
    ("<p a= b=\"x>y\">one</p>", "y\">one"),
    ("<script>if (a < b) '<p>no</p>'</script><textarea><p>no</textarea>", ""),
])
def test_html_unshown_elements_and_long_attributes(part, left):
    found = " ".join(b.text for b in html_extract.blocks_of(f"<body><div>{part}</div><article><p>The text.</p></article>"))
    assert found == f"{left} The text.".strip()


def test_html_unfinished_lists_keep_the_article():
    for part in ("<datalist><option value=a><option value=b></datalist>", "<select><option>one", "<svg><g>"):
        assert [(b.text, b.role) for b in html_extract.blocks_of(f"{part}<article><p>The text.</p></article>")] == [("The text.", 1)]


# pipeline
def test_pipeline_stages(spark, docs, empty):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    own = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES:
        assert stage(spark, own.limit(0), sf).count() == 0, name
    kept = P.exact_duplicates(spark, own, sf)
    near = P.near_duplicates(spark, kept, sf)
    rows = {r["doc_id"]: r["text"] for r in kept.select("doc_id", "text").collect()}
    want = brute_components(list(rows.values()), list(rows))
    assert sorted(r["doc_id"] for r in near.select("doc_id").collect()) == sorted({c for _, c in want.values()})
    assert near.columns == own.columns
    tokens = P.byte_bpe_tokens(spark, P.source_mixing(spark, near, sf), sf).collect()
    coder = byte_bpe.coder(RANKS, public_tokenizers.PATTERN)
    assert all(coder.decode(np.frombuffer(r["ids"], "<u4")).decode() == rows[r["doc_id"]] for r in tokens) and len(tokens) >= near.count()
