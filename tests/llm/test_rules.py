"""Quality rules against a plain count, and their defined results at the edges."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cellgrid.llm import rules

DIGEST = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    again = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), len(w) < 10 or 100 * len(again) > 20 * len(w)


def test_base_matches_plain_count(spark):
    rng = random.Random(2)
    texts = [None, "", " \t\n\x0b", "one", "a b c d e a b c d e", "a a a a a a", "a a a a a a a", "x\ny\nx\n\nx \n", "ß\x85z 𝔘𝔫 #*", "a b c d e f a b c d e f g\r\na", "|<>&%$*#"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) + rng.choice(["", "\n", "\n\n# x"]) for _ in range(60)]
    texts += texts[:4]  # repeated rows
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"lines": F.lit(1), "w": F.lit("w"), "kept": F.lit(0)})
    got = {r["doc_id"]: tuple(r)[1:] for r in rules.clean_lines(df).select(*DIGEST).collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("The line ends well.", None), ("It ends (“so”).", None), ("Is it? Then more without an end", None), ("你好，世界。", None), ("A sentence with a - dash and one | bar in it.", None),
        ("no end at all", "punctuation"), ("Too!! many!! marks!! here.", "punctuation"), ("many*** stars&&& here. again###", "punctuation"), ("3.5 is no end", "punctuation"),
        ("Home | News | Sport | More.", "navigation"), ("a » b » c", "navigation"), ("Read more...", "navigation"), ("Home", "navigation"), ("next", "navigation"),
        ("All rights reserved. 2020.", "boilerplate"), ("We uses cookies here. Fine.", "boilerplate"), ("PRIVACY POLICY. Read it.", "boilerplate"), ("The small rights reserved area.", None),
    ],
)
def test_line_rules(spark, line, rule):
    r = rules.clean_lines(spark.createDataFrame([(1, line)], "doc_id long, text string")).first()
    assert (r["n_lines"], r["n_navigation"], r["n_punctuation"], r["n_boilerplate"]) == (1, *(int(rule == x) for x in ("navigation", "punctuation", "boilerplate")))
    assert r["lost_words"] == (r["n_words"] if rule else 0)


def test_documents_that_lose_too_much_go(spark):
    good = "\n".join(" ".join(f"Word{10 * i + k}" for k in range(10)) + "." for i in range(6))
    nav = "Home | News | Sport | Shop"
    rows = [(1, good), (2, f"{nav}\n\n{good}\nAll rights reserved."), (3, f"{good}\n" + "\n".join(f"item {i} of a list | more | and | yet {i} | more" for i in range(9))), (4, nav), (None, good), (None, good)]
    rows.append((5, good + "\n" + " ".join(f"w{i}" for i in range(200_000)) + "."))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["kept"], r["clean_text"]) for r in rules.clean_lines(df).collect())
    assert got == [(0, True, good), (0, True, good), (1, True, good), (2, True, good), (3, False, None), (4, False, None), (5, True, rows[-1][1])]
    assert rules.clean_lines(df.limit(0)).count() == 0


def test_junk_goes_and_good_documents_stay(spark, data):
    kept = rules.clean_lines(spark.read.parquet(f"{data}/documents.parquet")).join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id")
    n = {tuple(r)[:2]: r["count"] for r in kept.groupBy("quality", "kept").count().collect()}
    assert n.get((0, True), 0) <= 0.05 * n[0, False] and n.get((1, False), 0) <= 0.1 * n[1, True]
