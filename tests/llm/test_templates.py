"""Decontamination against a plain search for planted passages, and re-parameterised questions."""

import random
import re

import pyarrow as pa

from flowlens.llm import templates as t
from flowlens.llm.arrowtext import texts_of
from flowlens.llm.queries import LLM


def squeezed(text):
    return " ".join(re.findall("[^\x20\x09-\x0D]+", text or ""))


def test_query_finds_every_planted_passage_and_no_other(spark, sf):
    docs = {r.doc_id: squeezed(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: squeezed(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {r.doc_id: r.item_ids for r in LLM.queries["op5_decontaminate"](spark, sf).collect()}
    assert sorted(got) == sorted(docs)
    for d, text in docs.items():
        whole = {str(i) for i, x in items.items() if x in text}
        found = set(filter(None, got[d].split(",")))
        assert whole <= found
        for i in found - whole:  # at least a run of ten words is shared
            w = items[int(i)].lower().split()
            assert any(" ".join(w[k: k + 5]) in text.lower() for k in range(len(w)))


ITEM = "If Alice has 12 apples and gives 5 apples to Bob Smith then walks 3 km home how many of the 12 apples does Alice still have"


def hits(texts, items, **rule):
    rule = t.Rule(**rule)
    return t.find_items(texts_of(pa.array(texts)), t.build_index(items, rule), rule)


def test_reparameterised():
    same = f"Intro words here. {ITEM}. And more."
    other = "x y. " + ITEM.replace("Alice", "Carol").replace("12", "40").replace("5 ", "7 ").replace("Bob Smith", "Dan").replace("3 km", "9 miles")
    broken = "x y. " + ITEM.replace("of the 12", "of the 99")
    found = hits([same, other, broken, "nothing of the kind is here at all today my friend", "", None], [ITEM])
    assert found[0] == [(0, 1.0, True)]
    assert found[1][0][0] == 0 and found[1][0][1] > 0.9 and not found[1][0][2]
    assert set(found) <= {0, 1, 2} and (2 not in found or found[2][0][1] < 1)


def test_inconsistent_slots_are_no_match():
    item = "take 7 of them and put 7 of them back into the big old box"
    assert 0 in hits([item.replace("7", "8")], [item])
    assert hits([item.replace("7", "8", 1)], [item]) == {}
    two = "take 7 of them and put 9 of them back into the big old box"
    assert hits([two.replace("9", "7")], [two]) == {}


def test_short_and_empty_items():
    assert hits(["say one small blue bird sings now"], ["small blue bird sings now"]) == {0: [(0, 1.0, True)]}
    assert hits(["so a b c d"], ["a b c d"]) == {0: [(0, 1.0, True)]}
    assert hits(["Who wrote Moby Dick?"], ["Who wrote Moby Dick?"]) == {0: [(0, 1.0, True)]}
    assert hits(["Who wrote Anna Karenina?", "a b c"], ["Who wrote Moby Dick?", "a b c d"]) == {}  # no templates of so few words
    numbers = "1 2 3 4 5 6 7 8 9 10 11"
    assert hits([numbers, "1 2 3 4 5 6 7 8 9 10 12"], [numbers, None, ""])[0] == [(0, 1.0, True)]
    assert hits([numbers.replace("1", "2")], [numbers]) == {}


def test_a_conflict_is_no_verbatim_copy():
    item = " ".join(["take 5 apples and put 5 apples back into the big old box near the door", *(f"w{i}" for i in range(20))])
    found = hits([item.replace("5", "12", 1)], [item])[0]
    assert found[0][0] == 0 and found[0][1] < 1 and not found[0][2]


def test_blocks_and_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(t, "BLOCK_BYTES", 40)
    items = spark.createDataFrame([(i, f"item{i} alpha{i} beta gamma delta epsilon zeta{i} eta") for i in range(12)] + [(None, None)], "item_id long, text string")
    rows = [(i, f"see this: item{i} alpha{i} beta gamma delta epsilon zeta{i} eta", "h") for i in range(12)] + [(3, None, "h"), (None, "", "h"), (50, "x " * 99_999, "h")]
    out = t.find_contamination(spark.createDataFrame(rows, "doc_id long, text string, hits string"), items)
    assert sorted((r.doc_id, [h.item_id for h in r.hits]) for r in out.collect() if r.text and r.hits) == [(i, [i]) for i in range(12)]
    assert out.count() == 15
    # several blocks leave one pass over stored rows: none is stacked on another, and a column named as the row number stays
    assert "MapInArrow" not in out._jdf.queryExecution().toString()
    clash = t.find_contamination(spark.createDataFrame([(*r[:2], "k") for r in rows], "doc_id long, text string, _row string"), items)
    assert {r._row for r in clash.collect()} == {"k"} and clash.columns == ["doc_id", "text", "_row", "hits"]
    assert t.find_contamination(out.limit(0), items).count() == 0
    assert t.find_contamination(out, items.limit(0)).filter("size(hits) > 0").count() == 0


def test_verbatim_copies_need_no_literal_share():
    short = "What is 12 times 5 minus 3?"
    assert hits([f"see: {short} yes"], [short]) == {0: [(0, 1.0, True)]}
    listed = "Mix 5 g salt 3 ml oil 20 g flour 7 ml milk 2 kg sugar"
    assert hits([f"so {listed} and"], [listed]) == {0: [(0, 1.0, True)]}
    assert hits([short.replace("12", "13")], [short]) == {}  # other numbers need the share
    assert hits([ITEM.upper(), ITEM.title()], [ITEM]) == {0: [(0, 1.0, True)], 1: [(0, 1.0, True)]}


def test_names_that_begin_sentences():
    item = "Maria has 12 red apples. Peter eats 5 green apples. Anna buys 7 more pears."
    other = "Olga has 30 red apples. Ivan eats 4 green apples. Vera buys 9 more pears."
    assert hits([other], [item]) == {0: [(0, 1.0, False)]}
    assert hits([other.replace("Vera", "Ivan")], [item]) == {}


def test_sentences_begin_after_lines_and_quotes():
    item = "Take the big box of Alice and 3 more"
    for before in ("A heading\n", 'she said "go on." ', "(so it was.) ", "he said “go on.” "):
        tokens = t.canonical(texts_of(pa.array([before + item])))
        assert tokens.readings[1].kind[-9] == t.LITERAL, before
        assert hits([before + item.replace("Alice", "Carol")], [item])[0][0][0] == 0


def test_a_conflict_drops_only_its_windows():
    words = [f"w{i}" for i in range(59)]
    words[20] = words[40] = "7"
    other = [*words]
    other[20] = "8"
    found = hits([" ".join(other)], [" ".join(words)])
    assert found[0][0][0] == 0 and 0.9 < found[0][0][1] < 1
    item = "take 12 of them and put 5 of them back into the big old box"
    assert hits([item.replace("12", "7").replace("5", "7")], [item]) == {0: [(0, 1.0, False)]}


def test_blocks_find_what_one_block_finds(spark, sf, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark"))
    whole = {r.doc_id: sorted(r.hits) for r in t.find_contamination(docs, items).select("doc_id", "hits").collect()}
    monkeypatch.setattr(t, "BLOCK_BYTES", (items.selectExpr("sum(octet_length(text))").first()[0] + 2) // 3)
    assert {r.doc_id: sorted(r.hits) for r in t.find_contamination(docs, items).select("doc_id", "hits").collect()} == whole
    assert any(whole.values())


def test_words_against_a_plain_search():
    rng = random.Random(3)
    word = lambda: rng.choice("ab cd ef gh ij".split())
    items = [[word() for _ in range(rng.choice([1, 2, 3, 6, 9]))] for _ in range(60)]
    docs = [[word() for _ in range(rng.randrange(30))] for _ in range(60)]
    got = hits([" ".join(d) for d in docs], [" ".join(i) for i in items], width=4)
    for d, doc in enumerate(docs):
        wanted = []
        for i, item in enumerate(items):
            w, covered = min(4, len(item)), set()
            for p in range(len(item) - w + 1):
                if any(doc[q: q + w] == item[p: p + w] for q in range(len(doc) - w + 1)):
                    covered.update(range(p, p + w))
            if 2 * len(covered) >= len(item):
                wanted.append((i, len(covered) / len(item), True))
        assert got.get(d, []) == wanted


def test_names_numbers_and_units_of_other_languages():
    item = "Im Laden kauft Élodie zwölf rote Äpfel und gibt danach fünf davon an Zoë weiter und läuft dann drei Stunden nach Hause zurück"
    other = item.replace("Élodie", "Ödön").replace("Zoë", "Łukasz").replace("zwölf", "zwanzig").replace("fünf", "sieben")
    assert hits([f"Vorweg. {other}"], [item])[0][0][1:] == (1.0, False)
    assert hits([item.upper()], [item]) == {0: [(0, 1.0, True)]}
    assert hits([item.replace("Äpfel", "äpfel")], [item]) == {0: [(0, 1.0, True)]}
