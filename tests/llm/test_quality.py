import re

from pyspark.sql import functions as F

from civicflow.llm import quality

TEXTS = ["", " \n\t", "a b c", "a b c a b c", "x\n x \nx\n\nx", "# * a|b <c>", "One two three. " * 30, "LOUD!! " * 60,
         " ".join(f"w{i}" for i in range(80)), "é ñ 日本 a b\x0bc", "to be or " * 20 + " ".join(f"u{i}" for i in range(200)), "w " * 5000]


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows, marked = [tuple(words[i:i + 3]) for i in range(len(words) - 2)], set()
    at = {}
    for i, w in enumerate(windows):
        at.setdefault(w, []).append(i)
    for found in at.values():
        if len(found) > 1:
            marked |= {i + d for i in found for d in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(marked), "n_lines": len(lines),
            "n_upper": len(re.findall("[A-Z]", text)), "n_exclaim": text.count("!")}


def test_measures_against_brute_force(spark, docs):
    df = docs([*TEXTS, None, "dup", "dup", (None, "a b", None, None, None)]).withColumn("n_words", F.lit("clash"))
    got = quality.ledger(df).collect()
    assert len(got) == len(TEXTS) + 4
    for r in got:
        assert {m: r[m] for m in quality.MEASURES} == measured(r["text"])


def test_ledger_bits_policies_and_ablations(spark, docs):
    df = docs([*TEXTS, None])
    entries = quality.ledger(df).cache()
    rows = entries.collect()
    for r in rows:
        fails = {"few_words": r["n_words"] < 50, "repeated_windows": 100 * r["n_repeat_words"] > 50 * r["n_words"]}
        for rule in quality.RULES[:2]:
            assert bool(r["fail_bits"] >> rule.bit & 1) == fails[rule.name]
    for policy in quality.POLICIES:
        mask = quality.mask(policy)
        kept = quality.apply_policy(entries, policy).where("kept").count()
        assert kept == sum(r["fail_bits"] & mask == 0 for r in rows)
        for a in quality.ablations(entries, policy).collect():
            bit = next(1 << x.bit for x in quality.RULES if x.name == a["rule"])
            assert a["n_failed"] == sum(bool(r["fail_bits"] & bit) for r in rows)
            assert a["n_only"] == sum(r["fail_bits"] & mask == bit for r in rows)
            assert a["n_kept_without"] == sum(r["fail_bits"] & mask & ~bit == 0 for r in rows)
    entries.unpersist()


def test_clean_labelled_documents_stay(spark, sf):
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    good = quality.verdicts(d).join(labels.where("quality = 1"), "doc_id").where("NOT base_failed")
    assert good.count() > 20 and good.where("NOT kept").count() == 0


def test_empty_table_and_plan_without_python(spark, docs):
    out = quality.verdicts(docs([]))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()


def test_input_columns_with_the_names_of_working_columns_stay(spark, docs):
    from pyspark.sql import functions as F

    df = docs(["a b c\nd", None]).withColumns({c: F.lit(c) for c in ("_w", "_l", "__w")})
    out = quality.ledger(df)
    assert out.columns == [*df.columns, *[c for c in out.columns if c not in df.columns]]
    for r in out.select(*df.columns, "n_words").collect():
        assert (r["_w"], r["_l"], r["__w"]) == ("_w", "_l", "__w") and r["n_words"] == (4 if r["text"] else 0)
