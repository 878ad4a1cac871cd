"""Benchmark passages in documents, also with other numbers, names and units; DataFrame functions only.

Words become a template: numbers, capitalised words inside a sentence and units after a number turn
into typed placeholders. Windows of template words are hash-joined with those of the benchmark items.
Each hit is then compared word by word, and within one alignment of an item and a document every
slot value of the item must always meet the same value of the document, or only literal windows count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from acreage.llm.common import SPACE, join_documents, stage, text_of

# What is stripped around words, placeholders, and units of measure.
EDGES = ".,;:!?\"'`()[]{}<>*#%&$@~^_=+|/\\-"
NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"
NUMERIC = "^[0-9]+([.,:/][0-9]+)*(st|nd|rd|th)?$"
SENTENCE_ENDS = [".", "!", "?", ":"]
UNITS = ["mm", "cm", "m", "km", "inch", "inches", "ft", "feet", "foot", "mile", "miles", "mg", "g", "kg", "lb", "lbs", "pounds",
         "ml", "l", "liters", "litres", "gallons", "s", "sec", "seconds", "min", "minutes", "h", "hours", "days", "weeks",
         "months", "years", "km/h", "mph", "usd", "eur", "dollars", "euros", "cents", "percent", "degrees", "kb", "mb", "gb"]
#: Most benchmark windows that are broadcast (about 100 bytes each); beyond, the join shuffles.
BROADCAST_WINDOWS = 500_000


def strip(word: Column) -> Column:
    """The word without punctuation around it; most words have none, which is cheaper to see than to trim."""
    edges = list(EDGES)
    touched = F.substring(word, -1, 1).isin(edges) | F.substring(word, 1, 1).isin(edges)
    return F.when(touched, F.btrim(word, F.lit(EDGES))).otherwise(word)


def digit_first(word: Column) -> Column:
    return (word >= "0") & (word < ":")


def template_word(word: Column, before: Column, raw_before: Column) -> Column:
    """Template form of a stripped word, given the stripped and the raw word before it (null at the start).

    Empty for a word of punctuation only. Plain words starting with a-z, the most frequent, come first."""
    low, first = F.lower(word), F.substring(word, 1, 1)
    unit = F.when(digit_first(before), F.when(before.rlike(NUMERIC) & low.isin(UNITS), F.lit(UNIT)).otherwise(low)).otherwise(low)
    inside = (raw_before != "") & ~F.substring(raw_before, -1, 1).isin(SENTENCE_ENDS)
    return (
        F.when((word >= "a") & (word < "{"), unit)
        .when(word == "", word)
        .when(digit_first(word), F.when(word.rlike(NUMERIC), F.lit(NUMBER)).otherwise(low))
        .when(unit == UNIT, F.lit(UNIT))
        .when((first != F.lower(first)) & inside & (F.substr(word, F.lit(2)) == F.substr(low, F.lit(2))), F.lit(NAME))
        .otherwise(low)
    )


def with_words(df: DataFrame, text: str, values: bool = False) -> DataFrame:
    """Add the columns `words`, the template, and with `values` also `plain`, the stripped words it stands for."""
    bare = df.withColumn("raw", F.split(text_of(text), SPACE, -1)).withColumn("bare", F.transform("raw", strip))
    word = lambda w, i: template_word(w, F.get("bare", i - 1), F.get("raw", i - 1))
    if not values:
        return bare.withColumn("words", F.filter(F.transform("bare", word), lambda w: w != "")).drop("raw", "bare")
    pair = F.transform("bare", lambda w, i: F.struct(word(w, i).alias("t"), F.lower(w).alias("v")))
    paired = bare.withColumn("pair", F.filter(pair, lambda x: x["t"] != ""))
    return paired.withColumns({"words": F.col("pair.t"), "plain": F.col("pair.v")}).drop("raw", "bare", "pair")


def key_of(words: list[Column]) -> Column:
    """Hash of word hashes; null ones, beyond the end of a shorter window, are left out."""
    return F.xxhash64(*words)


def window_keys(df: DataFrame, length: int) -> DataFrame:
    """Explode `words` into the keys of all windows: (doc_id, text_key, length, p, key).

    The words are hashed once and zipped with themselves shifted, so each window is a row of longs. Fewer words
    than `length` are one window."""
    hashed = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
    size = F.size("hashes")
    count = F.greatest(size - (length - 1), F.least(size, F.lit(1)))
    rows = F.arrays_zip(*[F.slice("hashes", k + 1, count).alias(f"h{k}") for k in range(length)])
    rows = hashed.select("doc_id", "text_key", F.least(F.lit(length), size).alias("length"), F.posexplode(rows).alias("p", "z"))
    return rows.select("doc_id", "text_key", "length", "p", key_of([F.col("z")[f"h{k}"] for k in range(length)]).alias("key"))


def item_windows(items: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """Windows of the items (key, length, item_id, item_words, q, bc, bv); a shorter item is one window."""
    words = with_words(items.select(F.col(item).alias("item_id"), F.col(text).alias("body")), "body", values=True)
    words = words.where(F.size("words") > 0).withColumn("length", F.least(F.lit(window), F.size("words")))
    places = F.sequence(F.lit(0), F.size("words") - F.col("length"))
    windows = F.transform(places, lambda s: F.struct(
        s.alias("q"), F.slice("words", s + 1, F.col("length")).alias("bc"), F.slice("plain", s + 1, F.col("length")).alias("bv")))
    out = words.select("item_id", F.size("words").alias("item_words"), "length", F.explode(windows).alias("w"))
    hashes = [F.when(F.col("length") > k, F.xxhash64(F.get("w.bc", F.lit(k)))) for k in range(window)]
    return out.select("item_id", "item_words", "length", "w.*", key_of(hashes).alias("key"))


def longest_run(places: Column) -> Column:
    """Length of the longest run of consecutive numbers in a sorted array; it is as long as an item at most."""
    def step(acc, x):
        n = F.when(x == acc["last"] + 1, acc["n"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), n.alias("n"), F.greatest(acc["best"], n).alias("best"))

    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("n"), F.lit(0).alias("best"))
    return F.aggregate(places, start, step, lambda acc: acc["best"])


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text", window: int = 8, coverage: float = 0.5, run: int = 13) -> DataFrame:
    """Documents and the items they hold: doc_id, text_key, item_id, n_windows, covered_words,
    item_words, longest_run, coverage, literal.

    A row stands for an item of whose template words at least `coverage`, or at least `run` in a row (`longest_run`),
    lie in matched windows of one document. Of an alignment whose slots are inconsistent only the windows count whose
    slot values are the item's own; `literal` tells that they are in all counted windows. A text
    with fewer words than the window is one window, so a shorter item is found only in a document of
    its very words. Documents and items without words (null, empty or only punctuation) match
    nothing; repeated rows of a document give one row per item, null keys are kept, and empty tables give an empty
    result. Other columns are not read.
    """
    windows = stage(item_windows(items, item, item_text, window), "items")
    keys = windows.select("key").distinct()
    if windows.count() <= BROADCAST_WINDOWS:
        keys = F.broadcast(keys)
    docs = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text_of(text).cast("binary")).alias("text_key"), text_of(text).alias("body"))
    hashed = with_words(docs, "body").select("doc_id", "text_key", "words")
    found = window_keys(hashed, window).join(keys, "key", "left_semi")
    found = stage(found.distinct(), "hits")
    per_doc = found.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("p", "length", "key")).alias("hits"))
    per_doc = per_doc.select(F.col("doc_id").alias("id2"), F.col("text_key").alias("key2"), "hits")
    per_doc = per_doc.hint("merge")  # the number of hits is not bounded
    holders = with_words(docs.join(per_doc, (F.col("text_key") == F.col("key2")) & F.col("doc_id").eqNullSafe(F.col("id2"))), "body", values=True)
    spans = F.transform("hits", lambda x: F.struct(
        x["p"].alias("p"), x["length"].alias("length"), x["key"].alias("key"),
        F.slice("words", x["p"] + 1, x["length"]).alias("dc"), F.slice("plain", x["p"] + 1, x["length"]).alias("dv")))
    # a document's repeated rows give equal spans
    spans = holders.select("doc_id", "text_key", F.explode(spans).alias("x")).select("doc_id", "text_key", "x.*").distinct()
    matched = spans.join(windows, ["key", "length"]).where(F.col("dc") == F.col("bc"))
    slots = F.filter(F.arrays_zip("bc", "bv", "dv"), lambda z: z["bc"].isin(NUMBER, NAME, UNIT))
    matched = matched.select("doc_id", "text_key", "item_id", "item_words", "length", "q", (F.col("p") - F.col("q")).alias("shift"),
                             slots.alias("slots"))
    matched = stage(matched.withColumn("own", F.forall("slots", lambda z: z["bv"] == z["dv"])), "matches")
    line = ["doc_id", "text_key", "item_id", "shift"]
    values = matched.select(*line, F.explode("slots").alias("z"))
    broken = values.groupBy(*line, "z.bc", "z.bv").agg(F.min("z.dv").alias("a"), F.max("z.dv").alias("b")).where("a <> b")
    broken = broken.select(*[F.col(c).alias(f"_{c}") for c in line], F.lit(True).alias("broken")).distinct()
    same = F.lit(True)
    for c in line:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    sound = matched.join(broken, same, "left").where(F.col("own") | (F.col("broken").isNull() & (F.col("length") == window)))
    group = ["doc_id", "text_key", "item_id"]
    covered = sound.select(*group, "item_words", "q", "own",
                           F.explode(F.sequence(F.col("q"), F.col("q") + F.col("length") - 1)).alias("word"))
    out = covered.groupBy(*group, "item_words").agg(
        F.countDistinct("q").alias("n_windows"), F.array_sort(F.collect_set("word")).alias("places"), F.min("own").alias("literal"))
    out = out.withColumns({"covered_words": F.size("places").cast("long"), "longest_run": longest_run(F.col("places")).cast("long")})
    share = F.col("covered_words") / F.col("item_words")
    return out.withColumn("coverage", share).where((share >= coverage) | (F.col("longest_run") >= run)).select(
        "doc_id", "text_key", "item_id", "n_windows", "covered_words", F.col("item_words").cast("long").alias("item_words"),
        "longest_run", "coverage", "literal")


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """`docs` without the rows that hold a benchmark item; null texts stay, columns are unchanged."""
    bad = leaks(docs, items, key, text, **how).select("doc_id", "text_key").distinct()
    return join_documents(docs, bad, key, text, "left_anti").select("doc.*")
