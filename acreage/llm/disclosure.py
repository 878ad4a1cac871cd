"""Sanitising personal data by what terms disclose.

Addresses, numbers and phones found by patterns are the protected entities. How strongly another term reveals one of
them is estimated from where they stand together in the whole corpus: the pointwise mutual information of a term
and an entity, against the information of the entity itself. Where it comes to a set share, reading the
term is nearly as good as reading the entity, so the term is generalised to its class, or removed
where its class would still tell too much. The unit of the estimate is a term's place, near an
entity or not, so the pairs grow with the entities' mentions and never with the square of a document.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from acreage.llm.common import join_documents, slices, split_join, stage, text_of

#: Kinds of entities, in the order of the results, and what may happen to other terms.
KINDS = ("email", "ip", "card", "phone")
CHANGES = ("generalise", "remove")
#: The patterns read texts once from the left: nothing is given back, and no run of digits is begun in its middle.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile("[^0-9]+")
#: Terms are runs of letters and digits; longer ones than LONGEST are named by a digest.
TERM = re.compile(r"[^\W_]+")
LONGEST = 64
#: Bytes of text a worker takes up at once, and entries a task holds before it sends them on.
SLICE, HELD = 4 << 20, 500_000
SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        value = int(c) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the letters of a local part before it, back to the last match or @, and a domain after it."""
    low, at = 0, text.find("@")
    while at >= 0:
        before = text[low:at]
        start = low + len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        low = domain.end() if domain else at + 1
        at = text.find("@", low)


def entities(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of all entities of a text, by kind and then start; values are alike for one entity."""
    out = [(0, s, e, text[s:e].lower()) for s, e in emails(text)]
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append((1, m.start(), m.end(), ".".join(parts)))
    for m in CARD.finditer(text):
        digits = DIGITS.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end(), digits))
    if "+" in text:
        for m in PHONE.finditer(text):
            digits = DIGITS.sub("", m.group())
            if 9 <= len(digits) <= 15:
                out.append((3, m.start(), m.end(), digits))
    return out


def blanked(text: str, spans: list[tuple[int, int, int, str]]) -> str:
    """The text with spaces over its entities, so that no term is part of one."""
    out, at = [], 0
    for _, s, e, _ in sorted(spans, key=lambda x: x[1]):
        if e > at:
            out += [text[at:max(s, at)], " " * (e - max(s, at))]
            at = e
    return "".join([*out, text[at:]]) if out else text


def name_of(term: str) -> str:
    term = term.lower()
    return term if len(term) <= LONGEST else f"#{placeholder(term)[1:-1]} {hashlib.sha256(term.encode()).hexdigest()}"


def class_of(term):
    """The class a term is generalised to, as a Spark expression of its name."""
    digits, letters = term.rlike("[0-9]"), term.rlike("[^0-9]")
    short = F.when(digits & letters, "code").when(digits, "number").otherwise("word")
    return F.when(term.startswith("#"), F.regexp_extract(term, "^#([a-z]+)", 1)).otherwise(short)


def placeholder(term: str) -> str:
    digits = sum("0" <= c <= "9" for c in term)
    return "<number>" if digits == len(term) else "<code>" if digits else "<word>"


def terms_near(text: str, start: int, end: int, reach: int) -> list[tuple[int, str]]:
    """(start, name) of the terms that lie wholly within `reach` code points of a span of a blanked text."""
    out = []
    for low, high in ((max(0, start - reach), start), (end, min(len(text), end + reach))):
        for m in TERM.finditer(text, low, high):
            begun = m.start() == low and low > 0 and TERM.match(text[low - 1])
            if not begun and not (m.end() == high and high < len(text) and TERM.match(text[high])):
                out.append((m.start(), name_of(m.group())))
    return out


def scan(docs: DataFrame, text: str, reach: int) -> DataFrame:
    """(entity, term, around, n): how often each term stands at all (entity null), and near each entity.

    `around` is a hash of the terms about a mention, by which copies of one passage are told from other mentions."""
    def send(held: Counter) -> pa.RecordBatch:
        entity, term, around = zip(*held)
        return pa.RecordBatch.from_arrays(
            [pa.array(entity, pa.int64()), pa.array(term, pa.string()), pa.array(around, pa.int64()), pa.array(held.values(), pa.int64())],
            ["entity", "term", "around", "n"])

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    def run(batches):
        terms: Counter = Counter()
        pairs: Counter = Counter()
        for batch in slices(batches, "body", SLICE):
            for body in batch.column("body").to_pylist():
                if not body:
                    continue
                found = entities(body)
                blank = blanked(body, found)
                for term, n in Counter(TERM.findall(blank)).items():
                    terms[None, name_of(term), 0] += n
                seen: set[tuple[int, int]] = set()
                for kind, s, e, value in found:
                    entity = signed(xxhash.xxh64_intdigest(f"{KINDS[kind]}:{value}"))
                    near = terms_near(blank, s, e, reach)
                    around = signed(xxhash.xxh64_intdigest(" ".join(t for _, t in near)))
                    for place, term in near:
                        if (entity, place) not in seen:
                            seen.add((entity, place))
                            pairs[entity, term, around] += 1
                for held in (terms, pairs):
                    if len(held) >= HELD:
                        yield send(held)
                        held.clear()
        for held in (terms, pairs):
            if held:
                yield send(held)

    return docs.select(F.col(text).alias("body")).mapInArrow(run, "entity long, term string, around long, n long")


def revealing_terms(docs: DataFrame, text: str = "text", alpha: float = 1.02, support: int = 3, reach: int = 60) -> DataFrame:
    """(term, n, remove): terms that disclose an entity, how often they stand, and whether their class does so too.

    With p over the places of all terms, a term t discloses an entity e if PMI(e; t) >= IC(e) / alpha, where
    IC(e) = -log p(near e) and PMI = log(p(t, near e) / (p(t) p(near e))), and if it stands near e in at least `support`
    different surroundings. An alpha of 1 asks that the term stands nowhere else.
    """
    counted = stage(scan(docs, text, reach), "terms")
    words = stage(counted.where("entity IS NULL").groupBy("term").agg(F.sum("n").alias("n")), "vocabulary")
    total = float(words.agg(F.sum("n")).first()[0] or 0)
    mentions = counted.where("entity IS NOT NULL").groupBy("entity", "term", "around").agg(F.sum("n").alias("n"))
    pairs = stage(mentions.groupBy("entity", "term").agg(F.sum("n").alias("near"), F.count(F.lit(1)).alias("places"))
                  .withColumn("class", class_of(F.col("term"))), "near")
    sizes = words.groupBy(class_of(F.col("term")).alias("class")).agg(F.sum("n").alias("size"))  # three rows
    # a term discloses an entity while it stands at most near * (total / near the entity) ** (1 - 1 / alpha) times
    slack = F.pow(F.lit(total) / F.col("of_entity"), F.lit(1 - 1 / alpha))
    classes = pairs.groupBy("entity", "class").agg(F.sum("near").alias("near"), F.sum((F.col("places") >= support).cast("long")).alias("rows"))
    told = classes.join(F.broadcast(sizes), "class").groupBy("entity").agg(
        F.sum("near").alias("of_entity"), F.sum("rows").alias("n"), F.collect_list(F.struct("class", "near", "size")).alias("classes"))
    # three classes at most in each list
    told = stage(told.where("n > 0").withColumn("slack", slack).select("entity", "n", "slack", F.transform(
        F.filter("classes", lambda c: c["size"] <= c["near"] * F.col("slack")), lambda c: c["class"]).alias("broken")), "entities")
    candidates = pairs.where(F.col("places") >= support)
    limit = F.col("near") * F.col("slack")
    limits = split_join(candidates, told, ["entity"], max(1.0, candidates.count() / 1024)).groupBy("term").agg(
        F.max(limit).alias("limit"), F.max(F.when(F.array_contains("broken", F.col("class")), limit)).alias("class_limit"))
    return words.join(limits, "term").where("n <= limit").select(
        "term", "n", (F.col("n") <= F.coalesce("class_limit", F.lit(0.0))).alias("remove"))


def changed(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with placeholders over its spans; of overlapping ones the first by start names the whole."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: x[1:]):
        if s >= at:
            out += [text[at:s], "" if kind == "remove" else placeholder(text[s:e]) if kind == "generalise" else f"<{kind}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mark(body: str, terms: dict[str, bool], rewrite: bool) -> dict:
    """The spans of a text, entities first, and the text without what they hold."""
    found = entities(body)
    blank = blanked(body, found)
    spans = [(KINDS[kind], s, e) for kind, s, e, _ in found]
    hit = {t for t in set(TERM.findall(blank)) if name_of(t) in terms} if terms else ()
    if hit:
        others = [(CHANGES[terms[name_of(m.group())]], m.start(), m.end()) for m in TERM.finditer(blank) if m.group() in hit]
        spans += sorted(others, key=lambda x: (CHANGES.index(x[0]), x[1]))
    return {"spans": [{"kind": k, "start": s, "end": e} for k, s, e in spans], "text": changed(body, spans) if rewrite else None}


def sanitise(
    docs: DataFrame, key: str = "doc_id", text: str = "text", output: str = "privacy", alpha: float = 1.02, support: int = 3,
    reach: int = 60, rewrite: bool = True, most: int = 500_000,
) -> DataFrame:
    """`docs` with `output`, a struct of `spans` (kind, start, end in code points, end exclusive) and the sanitised `text`.

    Spans are the entities (email, ip, card, phone, each kind leftmost and non-overlapping, so that spans of two kinds may
    overlap), then the terms outside them to generalise or remove (see `revealing_terms`), by kind and start. The text has
    placeholders for entities and for generalised terms; with `rewrite` off it is null. Null and empty texts have
    no spans and stay as they are; rows that repeat have the same spans; an input column named as the output is
    replaced; an empty table gives an empty result. The revealing terms are given to all tasks while they are at most
    `most`; more are joined to the documents that hold them.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != output])
    terms = stage(revealing_terms(docs, text, alpha, support, reach), "revealing")
    schema = T.StructType([*docs.schema.fields, T.StructField(output, T.StructType([
        T.StructField("spans", T.ArrayType(SPAN)), T.StructField("text", T.StringType())]))])
    kind = pa.struct([("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))), ("text", pa.string())])

    def marked(bodies, lists):
        nothing = {"spans": [], "text": "" if rewrite else None}
        return pa.array([mark(b, t, rewrite) if b else nothing if b is not None else {"spans": [], "text": None}
                         for b, t in zip(bodies, lists)], kind)

    if terms.count() <= most:
        table = {r["term"]: r["remove"] for r in terms.collect()}
        sent = docs.sparkSession.sparkContext.broadcast(table)

        def run(batches):
            known = sent.value
            for batch in slices(batches, text, SLICE):
                bodies = batch.column(text).to_pylist()
                yield pa.RecordBatch.from_arrays([*batch.columns, marked(bodies, [known] * len(bodies))], [*batch.schema.names, output])

        return docs.mapInArrow(run, schema)

    # every document's own revealing terms, of which it holds no more than words
    held = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text_of(text).cast("binary")).alias("text_key"), F.col(text).alias("body"))

    def split(batches):
        for batch in slices(batches, "body", SLICE):
            for k, body in enumerate(batch.column("body").to_pylist()):
                names = sorted({name_of(t) for t in TERM.findall(body or "")})
                if names:
                    row = [pa.repeat(batch.column(c)[k], len(names)) for c in ("doc_id", "text_key")]
                    yield pa.RecordBatch.from_arrays([*row, pa.array(names)], ["doc_id", "text_key", "term"])

    name = held.schema["doc_id"].dataType.simpleString()
    rows = held.mapInArrow(split, f"doc_id {name}, text_key long, term string")
    bar = max(1.0, (terms.agg(F.sum("n")).first()[0] or 0) / 1024)
    found = split_join(rows, terms, ["term"], bar).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("term", "remove")).alias("terms"))
    joined = join_documents(docs, found, key, text, "left")
    columns = [f"c{i}" for i in range(len(docs.columns))]
    flat = joined.select(*[F.col("doc")[c].alias(n) for c, n in zip(docs.columns, columns)], "terms")
    place = docs.columns.index(text)

    def run_joined(batches):
        for batch in slices(batches, columns[place], SLICE):
            lists = [{t["term"]: t["remove"] for t in x or []} for x in batch.column("terms").to_pylist()]
            made = marked(batch.column(columns[place]).to_pylist(), lists)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], [*docs_names, output])

    docs_names = list(docs.columns)
    return flat.mapInArrow(run_joined, schema)


def disclosure_digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Spans are written kind:start:end and joined by commas; base_sha256 is of those of the four kinds, of nothing for
    texts without any. Null counts as empty."""
    found = sanitise(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), rewrite=False)
    spans = F.col("privacy.spans")

    def written(some):
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter(spans, lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(written(of(*KINDS)).cast("binary"), 256).alias("base_sha256"),
        written(spans).alias("spans"))
