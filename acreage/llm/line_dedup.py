"""Repeated line runs by winnowing over line hashes, in DataFrame functions only.

Of every `window` consecutive lines the one of least hash is selected as fingerprint, once for all windows that
select it. Positions whose fingerprint is held by another position too are extended both ways over the
windows that selected them; equal windows select the same line, so none is missed. The union of
repeated windows is the maximal repeated run. The first occurrence by document and position stays. Long lines
count by themselves too, each its own fingerprint; with a window of one line every line does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from acreage.llm.common import SPACE, join_documents, split_join, stage, text_of

NOT_SPACE = SPACE.replace("[", "[^", 1)
SHARE = 1 / 1024


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def units_of(lines: Column) -> Column:
    """Non-blank lines as (at, unit, h, g, words): place in the document, place among these lines, two independent hashes."""
    trimmed = F.transform(lines, lambda line, i: F.struct(i.alias("at"), F.trim(line, F.lit(" \t\r")).alias("t")))
    return F.transform(F.filter(trimmed, lambda x: x["t"] != ""), lambda x, i: F.struct(
        x["at"].alias("at"), i.alias("unit"), F.xxhash64(x["t"]).alias("h"), F.xxhash64(F.lit(1), x["t"]).alias("g"),
        F.regexp_count(x["t"], F.lit(NOT_SPACE)).alias("words")))


def positions_of(units: Column, window: int) -> Column:
    """The fingerprints as (at, first, last): the line of least hash in a window, the leftmost of equal ones, and the
    first and the last window that select it. Equal windows select the same of their lines."""
    least = lambda s: F.array_min(F.transform(F.slice(units, s + 1, window), lambda u, i: F.struct(
        u["h"].alias("h"), (s + i).alias("at"))))["at"]
    starts = F.when(F.size(units) >= window, F.sequence(F.lit(0), F.size(units) - window)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.struct(s.alias("s"), least(s).alias("at")))


def runs_of(picks: Column) -> Column:
    """One entry per selected line from the picks of all windows; a line is selected by windows in a row."""
    change = lambda x, i: (i == 0) | (F.get(picks, i - 1)["at"] != x["at"])
    heads = F.filter(picks, change)
    return F.transform(heads, lambda x: F.struct(x["at"].alias("at"), x["s"].alias("first")))


def once(rows: DataFrame, name: str) -> DataFrame:
    """`rows` with the array `name` computed once a row: a later expression over its elements would else hold, and
    compute, the whole array again for each of them."""
    return rows.select(*[c for c in rows.columns if c != name], F.explode(F.array(name)).alias(name))


def positions(rows: DataFrame, window: int, min_words: int) -> DataFrame:
    """One row per selected fingerprint position: doc_id, text_key, length (of its windows), finger, first (the first
    window that selects it), and the hashes `h` and `g` of all lines that these windows reach."""
    keys = ["doc_id", "text_key"]
    lone = rows.select(*keys, F.explode("units").alias("u"), F.lit(1).alias("length"))
    lone = lone.select(*keys, "length", F.col("u.h").alias("finger"), F.col("u.unit").alias("first"),
                       F.array("u.h").alias("h"), F.array("u.g").alias("g"), F.col("u.words").alias("words"))
    if window == 1:
        return lone.drop("words")
    picked = once(once(rows, "units").withColumn("picks", positions_of(F.col("units"), window)), "picks")
    picked = once(picked.withColumn("heads", runs_of(F.col("picks"))), "heads")
    end = lambda i: F.coalesce(F.get("heads", i + 1)["first"], F.size("picks"))
    reached = F.transform("heads", lambda x, i: F.struct(
        F.get("units", x["at"])["h"].alias("finger"), x["first"].alias("first"),
        F.slice("units", x["first"] + 1, end(i) - 1 - x["first"] + window).alias("lines")))
    picked = picked.select(*keys, F.explode(reached).alias("x")).select(
        *keys, F.lit(window).alias("length"), "x.finger", "x.first", "x.lines.h", "x.lines.g")
    return picked.unionByName(lone.where(F.col("words") >= min_words).drop("words"))


def repeated_units(rows: DataFrame, window: int, min_words: int) -> DataFrame:
    """Per document (doc_id, text_key) the numbers of the lines to delete (`gone`), and how many of them lie in repeated
    windows (`n_in_runs`), from `rows` with their units."""
    selected = stage(positions(rows, window, min_words), "positions")
    bar = max(2, selected.count() * SHARE)
    fingers = selected.groupBy("length", "finger").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = split_join(selected, stage(fingers, "fingers"), ["length", "finger"], bar)
    # from a line that two positions share, extend both ways to each window that selected it
    reach = F.size("h") - F.col("length")
    met = met.select("doc_id", "text_key", "length", "first", "h", "g", F.explode(F.sequence(F.lit(0), reach)).alias("o"))
    part = lambda c: F.xxhash64(F.slice(c, F.col("o") + 1, F.col("length")))
    matched = stage(met.select("doc_id", "text_key", "length", (F.col("first") + F.col("o")).alias("start"),
                               part("h").alias("k1"), part("g").alias("k2")), "matches")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "start")
    firsts = matched.groupBy("k1", "k2", "length").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    later = split_join(matched, stage(firsts.where("n > 1"), "firsts"), ["k1", "k2", "length"], bar)
    is_first = (F.col("text_key") == F.col("first.text_key")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    later = later.where(~(is_first & (F.col("start") == F.col("first.start"))))
    units = F.explode(F.sequence("start", F.col("start") + F.col("length") - 1))
    run = F.when(F.col("length") == window, F.col("unit"))
    return later.select("doc_id", "text_key", "length", units.alias("unit")).groupBy("doc_id", "text_key").agg(
        F.collect_set("unit").alias("gone"), F.size(F.collect_set(run)).alias("n_in_runs"))


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 2, min_words: int = 50) -> DataFrame:
    """`docs` with a struct column `dedup`: the text left (`text`), `n_lines`, `n_removed` and `n_in_runs` (of the removed
    lines, those in repeated runs of at least `window` lines).

    Deleted is every line inside a run of `window` lines, or a line of `min_words` words, that occurs
    earlier in the order of key, text hash and line; runs are judged on the input. Lines are compared
    without surrounding blanks; blank lines count in no run and stay. Null text stays null, a null key
    comes last, and rows that repeat key and text are judged as one document. Short and long
    texts are alike; an empty table gives an empty result. Other columns pass through
    whatever their names, but an input column `dedup` is replaced.
    """
    text_key = F.xxhash64(text_of(text).cast("binary")).alias("text_key")
    units = units_of(lines_of(text_of(text))).alias("units")
    gone = repeated_units(docs.select(F.col(key).alias("doc_id"), text_key, units), window, min_words)
    joined = join_documents(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "dedup"]), gone, key, text, "left")
    before = F.col(f"doc.`{text}`")
    cut = lines_of(F.coalesce(before, F.lit("")))
    joined = joined.withColumns({"cut": cut, "at": F.when(F.col("gone").isNotNull(), units_of(cut)["at"])})
    numbers = F.transform("gone", lambda u: F.col("at")[u])
    left = F.array_except(F.sequence(F.lit(0), F.size("cut") - 1), numbers)
    kept = F.array_join(F.transform(left, lambda i: F.element_at(F.col("cut"), i + 1)), "\n")
    result = F.struct(
        F.when(F.col("gone").isNull(), before).otherwise(kept).alias("text"), F.size("cut").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_in_runs", F.lit(0)).cast("long").alias("n_in_runs"))
    return joined.withColumn("result", result).select("doc.*", F.col("result").alias("dedup"))
