"""Base statistics and verdicts against plain Python and numpy."""

import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from flowlens.llm import outliers as o
from flowlens.llm.queries import LLM

WORD = re.compile("[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[i: i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i: i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def vector(text):
    n, chars, symbols, dups, again = base(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    upper = sum(c.isupper() and re.fullmatch(r"\w", c) is not None for c in text)
    other = sum(not c.isalpha() and not c.isspace() for c in text)
    return [round(v * 1024) for v in (np.log(chars / n), *np.sqrt([symbols / chars, upper / chars, other / chars,
                                                                  dups / max(1, len(lines)), again / n]))]


def brute(rows, rules):
    """doc_id -> kept, with numpy linear algebra and full sorting instead of histograms and sweeps."""
    good = {r.doc_id: r for r in rows if (b := base(r.text))[0] >= rules.min_words and 100 * b[4] <= rules.max_repeat_percent * b[0]}
    fine, coarse = Counter((r.lang, r.source) for r in good.values()), Counter(r.lang for r in good.values())
    cells = defaultdict(list)
    for r in good.values():
        cells[(r.lang, r.source) if fine[r.lang, r.source] >= rules.min_rows else
              (r.lang,) if coarse[r.lang] >= rules.min_rows else ()].append(r)
    floors = np.array(o.FLOORS) * o.UNIT
    kept = {r.doc_id: False for r in rows}
    for members in cells.values():
        x = np.array([vector(r.text) for r in members], float)
        rank = lambda q: np.sort(x, 0)[int(np.ceil(q * len(x))) - 1]
        centre = rank(0.5)
        inverse = np.diag(1 / np.maximum((rank(0.75) - rank(0.25)) / 1.349, floors) ** 2)
        for step in range(rules.steps + 1):
            d2 = np.einsum("ij,jk,ik->i", x - centre, inverse, x - centre)
            bins = np.floor(np.log2(d2 + 1e-6) * 64)
            reach = np.sort(bins)[int(np.ceil(rules.share * len(x))) - 1]
            if step < rules.steps:
                near = x[bins <= reach]
                centre = near.mean(0)
                inverse = np.linalg.inv(np.cov(near.T, bias=True) + np.diag(floors**2))
        widen = max(1, 2 ** ((reach + 1) / 64) / o.CHI2_75[o.D])
        for r, v in zip(members, d2):
            kept[r.doc_id] = bool(v / widen <= rules.cutoff)
    return kept


def test_query_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in LLM.queries["op4_quality_rules"](spark, sf).collect()}
    want = brute(rows, o.Rules())
    assert len(got) == len(rows)
    for r in rows:
        assert tuple(got[r.doc_id][c] for c in o.BASE) == base(r.text)
    assert {i: r.kept for i, r in got.items()} == want


def test_cells_of_every_level(spark, sf):
    rules = o.Rules(min_rows=8)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.kept for r in o.quality_rules(docs, rules).select("doc_id", "kept").collect()}
    assert got == brute(docs.collect(), rules)


def test_planted_junk_is_rejected_and_clean_text_kept(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    clean = o.quality_rules(docs).filter("quality = 1 AND NOT base_failed")
    assert clean.filter("NOT kept").count() <= 0.01 * clean.count()


def test_statistics_of_odd_texts(spark):
    texts = [None, "", " ", "a", "a b", "a b c", "a a a a", "x y z x y z", "\n\n a\n a\n", "é ß É", "a\x0bb\x0cc\x1cd",
             "w " * 20_000, "#*$%&|<>", "a\r\na\r\n", "1 2 3 4 1 2 3 2 3 4"]
    out = o.text_statistics(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = {r.doc_id: tuple(r[c] for c in o.BASE) for r in out.collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


def test_edge_tables(spark):
    schema = "doc_id long, text string, lang string, source string, kept string, cell string, n_words string"
    text = " ".join(f"Word{i}" for i in range(60))
    rows = [(1, text, None, None, "x", "y", "z"), (1, text, None, None, "x", "y", "z"), (2, text, "en", None, None, None, None),
            (None, None, None, "s", None, None, None)]
    out = o.quality_rules(spark.createDataFrame(rows, schema)).select("doc_id", "kept", "cell").collect()
    assert sorted((r.doc_id or 0, r.kept, r.cell) for r in out if r.doc_id) == [(1, True, "y"), (1, True, "y"), (2, True, None)] and len(out) == 4
    assert o.quality_rules(spark.createDataFrame([], schema)).count() == 0


def test_inverse(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(o.D, o.D))
    m = a @ a.T + np.eye(o.D)
    got = spark.range(1).select(o._inverse(F.array(*[F.lit(float(v)) for v in m.ravel()])).alias("x")).first().x
    assert np.allclose(np.array(got).reshape(o.D, o.D), np.linalg.inv(m))
