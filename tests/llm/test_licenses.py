import re

from civicflow.llm import licenses

MIT = licenses.TEMPLATES[0][0]
TEXTS = ["", "Released under the MIT License, or CC-BY 4.0.", "GNU General Public Licence", "GNU GENERAL\nPUBLIC (License) gnu general public license",
         "apache apache license license", "ccby cc by cc by", "mit licenſe mit lİcense Kit", "é mit license é" * 3,
         MIT, MIT.replace("charge to", "charge unto anyone and to"), " ".join(MIT.split()[::-1]), "mit license " * 3000, "a" * 10000]


def base(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    hits = [(i, label) for phrase, label in licenses.PHRASES for p in [phrase.split()] for i in range(len(w)) if w[i:i + len(p)] == p]
    return (len(w), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None),
            ",".join(sorted({x for _, x in hits})))


def test_base_against_brute_force_with_nulls_and_repeats(spark, docs):
    df = docs([*TEXTS, None, TEXTS[1], (None, TEXTS[1], None, None, None), (None, TEXTS[1], None, None, None), (1, "cc by", None, None, None)])
    want = sorted(((r["doc_id"] is None, r["doc_id"] or 0, *map(str, base(r["text"]))) for r in df.collect()))
    rows = licenses.scan(df).collect()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, *map(str, (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]))) for r in rows)
    assert got == want
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))


def test_longer_templates_across_diagonals(spark, docs):
    rows = {r["doc_id"]: r for r in licenses.scan(docs(TEXTS)).collect()}
    whole, edited, reversed_ = (TEXTS.index(t) for t in (TEXTS[8], TEXTS[9], TEXTS[10]))
    assert rows[whole]["labels"] == "mit" and rows[whole]["score"] == 1.0 and rows[whole]["n_base"] == 0
    assert rows[edited]["labels"] == "mit" and 0.8 < rows[edited]["score"] < 1
    assert rows[reversed_]["labels"] == "" and rows[reversed_]["score"] == 0


def test_empty_table_and_plan_without_python(spark, docs):
    out = licenses.scan(docs([]))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().toString()


def test_whole_licences_are_templates(spark, docs):
    """Templates of several hundred words (several bit sets), found whole, edited and
    wrapped in other text; a text with its parts in disorder is none."""
    import random

    rng = random.Random(3)
    vocabulary = [f"t{i}" for i in range(90)]
    long = [rng.choice(vocabulary) for _ in range(400)]
    other = [rng.choice(vocabulary) for _ in range(130)]
    edited = long[:]
    for at in range(390, 0, -20):
        edited[at:at + 1] = [] if at % 40 else ["new", "word"]
    parts = [long[i:i + 20] for i in range(0, 400, 20)]
    rng.shuffle(parts)
    texts = [" ".join(["x"] * 7 + long + ["y"] * 5), " ".join(edited), " ".join(sum(parts, [])), " ".join(other), " ".join(long + other), " ".join(long[:150])]
    templates = [(" ".join(long), "long"), (" ".join(other), "other"), ("a b", "ab")]
    rows = licenses.spans(docs(texts), templates=templates).where("NOT is_phrase").collect()
    got = {(r["doc_id"], r["label"]): r for r in rows}
    assert set(got) == {(0, "long"), (1, "long"), (3, "other"), (4, "long"), (4, "other")}
    assert (got[0, "long"]["first_word"], got[0, "long"]["last_word"], got[0, "long"]["coverage"]) == (7, 406, 1.0)
    assert (got[4, "other"]["first_word"], got[4, "other"]["last_word"]) == (400, 529)
    assert 0.8 < got[1, "long"]["coverage"] < 1


def test_a_table_of_templates_beyond_the_bound_is_not_broadcast_by_a_hint(spark, docs, monkeypatch):
    want = sorted(map(str, licenses.scan(docs(TEXTS)).collect()))
    monkeypatch.setattr(licenses, "BROADCAST_POSITIONS", 3)
    assert sorted(map(str, licenses.scan(docs(TEXTS)).collect())) == want


def test_wide_spans_are_none(spark, docs):
    """Three words of a template, three others, and so on: every diagonal is a
    neighbour of the last, but together they take nearly twice the template's words."""
    w = [f"t{i}" for i in range(60)]
    text = " ".join(" ".join(w[i:i + 3] + ["gap"] * 3) for i in range(0, len(w), 3))
    rows = licenses.spans(docs([text, " ".join(w)]), templates=[(" ".join(w), "long")]).collect()
    assert [(r["doc_id"], r["first_word"], r["last_word"]) for r in rows] == [(1, 0, 59)]
