"""Line-first quality rules, in DataFrame functions only.

Each line of a text is held against punctuation, navigation and boilerplate rules, lines that fail are taken out, and a
document that loses too much text by this is rejected. All is computed within the row, so nothing is shuffled; a text's
work grows with its length, but for one sort of the places of its repeated windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: [^\x20\x09-\x0D]+ as single characters, which Java looks up in one table; a class with a range or wide characters is slower.
WORD = r"[^ \t\n\x0B\f\r]+"
_SPACE = r"[ \t\n\x0B\f\r]"
SYMBOLS = "[#*$%&|<>]"
#: Base rules: fewest words, window of words, largest share of words in repeated windows in percent.
LEAST_WORDS, WINDOW, MOST_REPEATED = 10, 5, 20
#: Line rules: most marks (runs of symbols, doubled ! or ?) and most separators for each word, words of a menu entry.
MOST_MARKS, MOST_SEPARATORS, MENU_WORDS, MENU_CHARS = 0.3, 0.25, 4, 60
#: The largest share of its words that a document may lose.
MOST_LOST = 0.4

_CLOSE = "[\"'”’»)\\]]*"
#: A sentence end, at the end of the line or before more words: of Latin texts, and of others.
SENTENCE = rf"[.!?:;]{_CLOSE}(?:{_SPACE}|\z)", rf"[…。！？；：؟۔।]{_CLOSE}(?:{_SPACE}|\z)"
MARKS = rf"{SYMBOLS}+|[!?]{{2,}}"
SEPARATORS = r"(?:^|[ \t])(?:[|»«>›·•/→-]|::)(?:[ \t]|\z)"
SEPARATOR = r"[|»«>·/:\x2D\x{2000}-\x{2FFF}]"
#: Entries of menus, and phrases of notices, which may start with a capital or be in capitals.
MENU = (
    "home", "menu", "next", "previous", "back", "search", "login", "log in", "sign in", "sign up", "register", "share", "tweet", "print", "email", "comments", "read more", "more", "skip to content",
    "back to top", "contact", "contact us", "about", "about us", "sitemap", "faq", "startseite", "weiter", "suche", "anmelden", "kontakt", "impressum", "accueil", "suivant", "recherche", "connexion",
    "inicio", "siguiente", "buscar", "contacto",
)
NOTICES = (
    "all rights reserved", "alle rechte vorbehalten", "tous droits réservés", "todos los derechos reservados", "terms of use", "terms of service", "privacy policy", "cookie policy", "use of cookies",
    "uses cookies", "accept cookies", "enable javascript", "requires javascript", "lorem ipsum", "click here", "subscribe to our", "sign up for our", "follow us on", "share this", "powered by",
    "page not found", "copyright ©", "© copyright",
)
_WRITTEN = sorted({x for p in NOTICES for x in (p, p.capitalize(), p.upper())})
NOTICE = rf"(?:^|[ \t])(?:{'|'.join(_WRITTEN)})"
_FIRST_WORDS = sorted({x.split(" ")[0] for x in _WRITTEN})


def _let(value: Column, body) -> Column:
    """body of a value that is evaluated once, as the end of a fold over nothing; transform would copy what it returns."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda a, _: a, body)


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """How many of the words w stand in windows that occur twice or more in w, the first occurrence included.

    Windows are compared by digests of 64 bits of their words.
    """
    hashes = F.when(F.size(w) < window, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - window, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)])))

    def covered(sorted_places: Column) -> Column:
        at = lambda k: F.get(sorted_places, k)["h"]
        again = F.filter(sorted_places, lambda x, k: F.coalesce(x["h"] == at(k - 1), F.lit(False)) | F.coalesce(x["h"] == at(k + 1), F.lit(False)))
        step = lambda a, i: F.struct((i + window).alias("end"), (a["n"] + window - F.greatest(a["end"] - i, F.lit(0))).alias("n"))
        return F.aggregate(F.sort_array(F.transform(again, lambda x: x["i"])), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step, lambda a: a["n"])

    places = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_let(places(h), covered)))


def fault(line: Column, noticed: Column) -> Column:
    """The first rule that a line with words breaks, else null: navigation (items between separators, or an entry of a menu),
    punctuation (no sentence ends in it, or it is full of marks), boilerplate (a notice, sought only where noticed: a text without the first word of a notice holds none)."""
    words = F.regexp_count(line, F.lit(WORD))  # counted only where separators, marks or a short line ask for it
    dense = lambda some, pattern, most: line.rlike(some) & (F.regexp_count(line, F.lit(pattern)) > most * words)
    entry = (F.length(line) <= MENU_CHARS) & (words <= MENU_WORDS) & F.regexp_replace(F.lower(F.trim(line)), r"[^\p{L} ]", "").isin(*MENU)
    menu = dense(SEPARATOR, SEPARATORS, MOST_SEPARATORS) | entry
    spoilt = ~(line.rlike(SENTENCE[0]) | line.rlike(SENTENCE[1])) | dense(f"{SYMBOLS}|[!?]{{2}}", MARKS, MOST_MARKS)
    return F.when(menu, "navigation").when(spoilt, "punctuation").when(noticed & line.rlike(NOTICE), "boilerplate")


def judged_lines(text: Column, noticed: Column) -> Column:
    """array<struct<line, fault, lost>>: the \\n-split lines of a text that hold a word, with the words that a failing line takes away."""
    lost = lambda x, f: F.struct(x.alias("line"), f.alias("fault"), F.when(f.isNotNull(), F.regexp_count(x, F.lit(WORD))).otherwise(0).alias("lost"))
    return F.transform(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)), lambda x: _let(fault(x, noticed), lambda f: lost(x, f)))


def clean_lines(docs: DataFrame, most_lost: float = MOST_LOST) -> DataFrame:
    """One row per row of docs (doc_id, text, ...): doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_lines, n_navigation, n_punctuation, n_boilerplate (lines that fail), lost_words, kept and clean_text, the text
    without these lines (null where the document isn't kept).

    base_failed: fewer than 10 words, or over 20 % of them in repeated windows. kept: not base_failed, and at most
    most_lost of the words are in lines that fail. A null text counts as an empty one, and fails; rows with equal or null
    ids are judged one by one; other columns play no part; an empty table gives an empty table.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    first = F.array(*map(F.lit, _FIRST_WORDS))
    of = lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), repeated_words(w).alias("again"), F.arrays_overlap(w, first).alias("noticed"))
    words = docs.select("doc_id", text.alias("text")).select("doc_id", "text", _let(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), of).alias("w"))
    lines = words.select("doc_id", "text", "w", judged_lines(F.col("text"), F.col("w.noticed")).alias("lines"))
    dup_lines = (F.size("lines") - F.size(F.array_distinct("lines.line"))).cast("long").alias("n_dup_lines")
    lost = F.aggregate("lines.lost", F.lit(0), lambda a, x: a + x).cast("long").alias("lost_words")
    failing = lambda rule: F.size(F.filter("lines.fault", lambda x: x == rule)).cast("long").alias(f"n_{rule}")
    long = lambda c, name: F.col(c).cast("long").alias(name)
    rows = lines.select("doc_id", "text", "lines", "w", dup_lines, lost, F.size("lines").cast("long").alias("n_lines"), *map(failing, ("navigation", "punctuation", "boilerplate")))
    symbols = F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols")
    rows = rows.select("*", long("w.n", "n_words"), long("w.chars", "word_chars"), symbols, long("w.again", "n_repeat_words"))
    rows = rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("lost_words") <= most_lost * F.col("n_words")))
    clean = F.when(F.col("kept"), F.array_join(F.transform(F.filter("lines", lambda x: x["fault"].isNull()), lambda x: x["line"]), "\n"))
    return rows.withColumn("clean_text", clean).drop("text", "lines", "w")


def _sql_list(phrases: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{p}'" for p in phrases) + "]"


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT *, regexp_extract_all(t, '{WORD}') AS w FROM d),
g AS (SELECT k, i, w[i:i + {WINDOW - 1}] AS g FROM (SELECT k, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM s WHERE len(w) >= {WINDOW})),
again AS (SELECT k, count(DISTINCT i + j)::BIGINT AS n FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM g), range({WINDOW}) r(j) WHERE c > 1 GROUP BY k),
l AS (SELECT k, line, len(regexp_extract_all(line, '{WORD}')) AS n FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d)),
f AS (SELECT *, len(regexp_extract_all(line, {_sql_text(SEPARATORS)})) > {MOST_SEPARATORS} * n
    OR (length(line) <= {MENU_CHARS} AND n <= {MENU_WORDS} AND list_contains({_sql_list(MENU)}, regexp_replace(lower(trim(line)), '[^\p{{L}} ]', '', 'g')))
    OR NOT (regexp_matches(line, {_sql_text(SENTENCE[0])}) OR regexp_matches(line, {_sql_text(SENTENCE[1])})) OR len(regexp_extract_all(line, {_sql_text(MARKS)})) > {MOST_MARKS} * n
    OR regexp_matches(line, '{NOTICE}') AS fails FROM l WHERE n > 0),
x AS (SELECT k, (count(*) - count(DISTINCT line))::BIGINT AS dup, coalesce(sum(n) FILTER (fails), 0)::BIGINT AS lost FROM f GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, {_sql_text(SYMBOLS)}))::BIGINT AS n_symbols,
  coalesce(dup, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost_words,
  len(w) < {LEAST_WORDS} OR 100 * coalesce(n, 0) > {MOST_REPEATED} * len(w) AS base_failed,
  NOT (len(w) < {LEAST_WORDS} OR 100 * coalesce(n, 0) > {MOST_REPEATED} * len(w)) AND coalesce(lost, 0) <= {MOST_LOST} * len(w) AS kept
FROM s LEFT JOIN x USING (k) LEFT JOIN again USING (k)
"""
