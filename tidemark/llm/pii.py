"""Personal data: patterns, and terms that give a protected entity away by co-occurrence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import packed_row, settle

# The patterns of the contract. Quantifiers are possessive and starts anchored
# to where a run begins, which finds the same matches in time linear in the text.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)"
KINDS = (*PATTERNS, "term")
#: Share of an entity's information that a term may reveal before it is generalised, and
#: the share from which on it is removed.
GENERALISE, REMOVE = 0.9, 1.0
#: What a term can be: a run of letters and digits, in lower case; single ones are none.
TOKEN = r"[\p{L}\p{M}\p{N}]+"

_SPAN = "struct<kind:string,start:int,end:int,value:string>"


#: Running sums and maxima are taken within blocks of this many, then over the blocks, as an
#: array that grows by appending would be copied each time.
BLOCK = 128


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row; inside another lambda function a plain
    expression would be computed again for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each of ``values`` (numbers, none below zero), what ``join`` makes of zero and all
    up to it."""

    def grow(part: Column, start: Column) -> Column:
        grown = F.aggregate(part, F.array(start), lambda acc, x: F.concat(acc, F.array(join(F.element_at(acc, -1), x))))
        return F.slice(grown, 2, F.size(part))

    zero = F.lit(0)

    def blocks(v: Column) -> Column:
        count = F.ceil(F.size(v) / F.lit(BLOCK)).cast("int")
        numbers = F.when(count > 0, F.sequence(zero, count - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda k: F.slice(v, k * BLOCK + 1, F.lit(BLOCK)))

    def within(parts: Column) -> Column:
        ends = grow(F.transform(parts, lambda part: F.aggregate(part, zero, join)), zero)
        starts = F.concat(F.array(zero), ends)  # one more than there are blocks
        return F.flatten(F.zip_with(parts, F.slice(starts, 1, F.size(parts)), grow))

    return _let(values, lambda v: _let(blocks(v), within))


def _located(
    text: Column, pattern: str, kind: str, hits: Column, keep: Callable[[Column], Column]
) -> Column:
    """Spans of those ``hits``, the matches of a pattern in ``text``, that ``keep`` holds for.
    Offsets are sums over the pieces between matches, so that they count code points."""
    gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), 1, F.size(hits))
    ends = _running(F.zip_with(hits, gaps, lambda h, gap: gap + F.length(h)), lambda a, b: a + b)
    spans = F.zip_with(
        hits,
        ends,
        lambda h, end: F.struct(
            F.lit(kind).alias("kind"), (end - F.length(h)).alias("start"), end.alias("end"), h.alias("value")
        ),
    )
    return F.filter(spans, lambda s: keep(s["value"]))


def _rewritten(text: Column, spans: Column, put: Callable[[Column, Column], Column]) -> Column:
    """The text with ``put(span, covered)`` in place of each span; ``covered`` is how many code
    points it covers that no span before it does. Of spans that overlap, the one that starts
    first, then the longer one, comes first."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], -s["end"], s["kind"], s["value"])))
    ordered = F.transform(
        ordered,
        lambda s: F.struct(s["start"].alias("start"), (-s["col2"]).alias("end"), s["kind"].alias("kind"), s["value"].alias("value")),
    )

    def pieces(ordered: Column, before: Column, points: Column) -> Column:
        parts = F.zip_with(
            ordered,
            F.slice(before, 1, F.size(ordered)),
            lambda s, at: F.concat(
                F.array_join(F.slice(points, at + 1, F.greatest(s["start"] - at, F.lit(0))), ""),
                put(s, F.greatest(s["end"] - F.greatest(at, s["start"]), F.lit(0))),
            ),
        )
        rest = F.array_join(F.slice(points, F.element_at(before, -1) + 1, F.size(points)), "")
        return F.concat(F.array_join(parts, ""), rest)

    def rewritten(in_order: Column) -> Column:
        upto = _running(F.transform(in_order, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        # Cut from an array of code points: a cut from a text would count from its beginning.
        return _let(
            F.concat(F.array(F.lit(0)), upto),
            lambda before: _let(F.split(text, ""), lambda points: pieces(in_order, before, points)),
        )

    return F.when(F.size(spans) > 0, _let(ordered, rewritten)).otherwise(text)


def _keeper(kind: str) -> Callable[[Column], Column]:
    return lambda value: _valid(kind, value)


def _of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        size = F.length(digits)
        return F.when(size.between(16, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def pattern_spans(df: DataFrame, text: str, into: str) -> DataFrame:
    """Add the spans of all patterns in column ``text`` as array ``into``, by kind and start."""
    column = F.col(text)
    hits = {k: F.regexp_extract_all(column, F.lit(p), F.lit(0)) for k, p in PATTERNS.items()}
    df = df.withColumns({f"{into}_{k}": h for k, h in hits.items()})
    none = F.array().cast(f"array<{_SPAN}>")
    spans = [
        F.when(
            F.size(f"{into}_{k}") > 0,
            _located(column, PATTERNS[k], k, F.col(f"{into}_{k}"), _keeper(k)),
        ).otherwise(none)
        for k in PATTERNS
    ]
    return df.withColumn(into, F.concat(*spans)).drop(*[f"{into}_{k}" for k in PATTERNS])


def _words(text: Column) -> Column:
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)))
    return F.filter(found, lambda w: F.length(w) > 1)


def _outside(text: Column) -> Column:
    """The text with its base spans blank, whose words are no terms; offsets stay."""
    return _rewritten(text, F.col("base"), lambda span, covered: F.repeat(F.lit(" "), covered))


def _entities(span: Column) -> Column:
    """What a span stands for, however it is written, and what it shares with others: the mail
    domain, the network of 256 addresses, the first six digits of a card or phone number."""
    digits = F.regexp_replace(span["value"], "[^0-9]", "")
    own = F.when(span["kind"].isin("card", "phone"), digits).otherwise(F.lower(span["value"]))
    shared = (
        F.when(span["kind"] == "email", F.concat(F.lit("@"), F.substring_index(own, "@", -1)))
        .when(span["kind"] == "ip", F.concat(F.substring_index(own, ".", 3), F.lit(".*")))
        .otherwise(F.concat(F.substring(digits, 1, 6), F.lit("*")))
    )
    return F.transform(F.array(own, shared), lambda e: F.concat(span["kind"], F.lit(":"), e))


def together(mentions: DataFrame, words: DataFrame, total: int, generalise: float) -> DataFrame:
    """(term, together, with_entity): in how many documents a term stands with an entity, and
    how many the entity has; only what two different texts support, and without what documents
    with an entity alone show to be too common (see ``revealing_terms``).

    ``mentions`` has row number, text hash and entity, each once, ``words`` row number and the
    array of a row's distinct terms; both are of whole documents. Entities of exactly the same
    documents are one here, as they stand with the same terms: a document full of addresses of
    its own is one entity. Terms move as one array a document; they are taken apart where the
    document's entities are.
    """
    number = F.xxhash64("rid")
    entities = (
        mentions.groupBy("entity")
        .agg(
            F.struct(F.count(F.lit(1)), F.sum(number.cast("decimal(38,0)")), F.bit_xor(number)).alias("where"),
            F.count(F.lit(1)).alias("with_entity"),
            F.min("hash").alias("one"),
            F.max("hash").alias("other"),
        )
        .filter("one <> other")
    )
    # Any one entity of those that stand in the same documents tells which these are.
    places = settle(
        entities.groupBy("where", "with_entity")
        .agg(F.min("entity").alias("entity"))
        .select(F.monotonically_increasing_id().alias("place"), "entity", "with_entity")
    )
    held = settle(
        mentions.join(places, "entity")
        .groupBy("rid")
        .agg(F.min("hash").alias("hash"), F.collect_list("place").alias("places"))
    )
    known = words.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("at_least"))
    most = F.col("together") * F.exp((1 - generalise) * _information(total)) * (1 + 1e-9)
    return (
        held.join(words, "rid")
        .select("hash", "terms", F.explode("places").alias("place"))
        .select("hash", "place", F.explode("terms").alias("term"))
        .groupBy("place", "term")
        .agg(F.count(F.lit(1)).alias("together"), F.min("hash").alias("one"), F.max("hash").alias("other"))
        .filter("one <> other")
        .join(places.select("place", "with_entity"), "place")
        .join(known, "term")
        .filter(F.col("at_least") <= most)
        .select("term", "together", "with_entity")
    )


def _information(total: int) -> Column:
    """What an entity holds, by its share of all documents."""
    return F.log(F.lit(float(max(total, 2))) / F.col("with_entity"))


def revealing_terms(pairs: DataFrame, counts: DataFrame, total: int, generalise: float) -> DataFrame:
    """(term, share): terms that give away at least ``generalise`` of some entity.

    With probabilities as shares of documents, a term reveals PMI(term; entity), and the entity
    holds -log p(entity); share is their ratio, 1 when the term occurs in no document without
    the entity. ``pairs`` is what ``together`` gives, ``counts`` has the documents of each term.
    """
    information = _information(total)
    lost = F.log(F.greatest(F.col("with_term") / F.col("together"), F.lit(1.0)))
    share = F.when(information > 0, 1 - lost / information).otherwise(F.lit(0.0))
    known = pairs.join(counts, "term").select("term", share.alias("share")).filter(F.col("share") >= generalise)
    return known.groupBy("term").agg(F.max("share").alias("share"))


#: Bits that stand for terms that are looked for, 2 MB of bitmaps, and bits of one bitmap.
TERM_BITS, BITMAP = 1 << 24, 32768


def _maybe_among(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``rows`` less those whose ``term`` is surely not in ``terms``: each of these sets a bit at
    its hash, and the bitmaps are broadcast. What is kept has to meet the terms themselves."""
    at = F.pmod(F.xxhash64("term"), F.lit(TERM_BITS))
    bits = terms.select(at.alias("at")).groupBy(F.floor(F.col("at") / BITMAP).alias("__bucket")).agg(
        F.bitmap_construct_agg((F.col("at") % BITMAP).cast("long")).alias("__bits")
    )
    byte = F.substring("__bits", ((at % BITMAP) / 8).cast("int") + 1, F.lit(1))
    bit = F.call_function("shiftright", F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int"))
    placed = rows.withColumn("__bucket", F.floor(at / BITMAP)).join(F.broadcast(settle(bits)), "__bucket")
    return placed.filter(bit.bitwiseAND(F.lit(1)) == 1).select(*rows.columns)


def find(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    generalise: float = GENERALISE,
    carry: bool = False,
) -> DataFrame:
    """Personal data in whole texts: one row per row of ``docs``.

    Patterns give the base spans; their values are the protected entities, and so is what the
    values share (see ``_entities``). Words of documents with an entity are weighed by how
    strongly the corpus ties them to it, and those past the threshold are spans of kind
    ``term`` wherever they stand in any document. Base spans are no part of a term.

    Terms that two different texts have beside an entity are found first, in documents with
    entities alone; then the words of all documents are taken once, and of them only those
    terms are kept, to be counted and marked.

    Returns id, ``base`` and ``terms`` (arrays of kind, start, end, value; code points, end
    exclusive; by kind and start), ``removed`` (terms to remove rather than generalise), and
    with ``carry`` the struct ``row`` and ``content``, the text. A null text counts as empty;
    equal rows are treated alike; an empty table gives no rows.
    """
    content = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    found = pattern_spans(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(f"`{id_column}`").alias("id"),
            content.alias("content"),
            *([packed_row(docs).alias("row")] if carry else []),
        ),
        "content",
        "base",
    )
    # A carried row has the text already.
    found = settle(found.drop("content") if carry else found)
    if carry:
        found = found.withColumn("content", F.coalesce(F.col(f"row.`{text_column}`"), F.lit("")))
    mentions = (
        found.filter(F.size("base") > 0)
        .select("rid", F.xxhash64("content").alias("hash"), F.explode("base").alias("span"))
        .select("rid", "hash", F.explode(_entities(F.col("span"))).alias("entity"))
        .distinct()
    )
    plain = F.when(F.size("base") > 0, _outside(F.col("content"))).otherwise(F.col("content"))

    total = found.count()
    beside = settle(found.filter(F.size("base") > 0).select("rid", _words(plain).alias("terms")))
    pairs = settle(together(mentions, beside, total, generalise))
    candidates = settle(pairs.select("term").distinct())
    words = found.select("rid", F.explode(_words(plain)).alias("term"))
    hits = settle(_maybe_among(words, candidates).join(candidates, "term"))
    counts = hits.groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
    revealing = settle(revealing_terms(pairs, counts, total, generalise))
    listed = settle(hits.join(revealing, "term"))
    every = _located(plain, TOKEN, "term", F.regexp_extract_all(plain, F.lit(TOKEN), F.lit(0)), lambda w: F.length(w) > 1)
    tokens = (
        found.join(listed.select("rid").distinct(), "rid", "left_semi")
        .select("rid", F.explode(every).alias("span"))
        .withColumn("term", F.lower("span.value"))
    )
    terms = (
        _maybe_among(tokens, revealing.select("term"))
        .join(listed, ["rid", "term"])
        .groupBy("rid")
        .agg(
            F.array_sort(F.collect_list(F.struct("span.start", "span"))).alias("spans"),
            F.collect_set(F.when(F.col("share") >= REMOVE, F.col("term"))).alias("removed"),
        )
        .select("rid", F.transform("spans", lambda s: s["span"]).alias("terms"), "removed")
    )
    marked = found.join(terms, "rid", "left")
    return marked.select(
        F.col("id").alias(id_column),
        "base",
        F.coalesce("terms", F.array().cast(f"array<{_SPAN}>")).alias("terms"),
        F.coalesce("removed", F.array().cast("array<string>")).alias("removed"),
        *(["row", "content"] if carry else []),
    )


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts and digest columns of ``find``."""
    return found.select(
        id_column,
        *[
            F.size(_of_kind("base", k)).cast("long").alias(f"n_{k}")
            for k in PATTERNS
        ],
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat("base", "terms")).alias("spans"),
    )


def sanitised() -> Column:
    """The text of ``find(carry=True)`` with every span replaced by its class, and terms that
    reveal all of an entity removed. Where spans of two kinds overlap, the one that starts
    first, then the longer one, covers both."""

    def put(span: Column, covered: Column) -> Column:
        named = (
            F.when(span["kind"] != "term", F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
            .when(F.array_contains("removed", F.lower(span["value"])), F.lit(""))
            .when(span["value"].rlike(r"^\p{Lu}"), F.lit("[NAME]"))
            .otherwise(F.lit("[WORD]"))
        )
        # A span that begins inside another one goes with it.
        return F.when(covered == span["end"] - span["start"], named).otherwise(F.lit(""))

    return _rewritten(F.col("content"), F.concat("base", "terms"), put)


def sanitise(docs: DataFrame, id_column="doc_id", text_column="text", count_column="n_chars") -> DataFrame:
    """``docs`` with personal data replaced in the text, and its length where there is a
    column for it; other columns as they were. A null text stays null."""
    found = find(docs, id_column, text_column, carry=True).withColumn("clean", sanitised())
    values = {
        text_column: F.when(F.col(f"row.`{text_column}`").isNotNull(), F.col("clean")),
        count_column: F.when(
            F.col(f"row.`{text_column}`") != F.col("clean"), F.length("clean").cast("long")
        ).otherwise(F.col(f"row.`{count_column}`")) if count_column in docs.columns else None,
    }
    return found.select(
        *[(values[c] if values.get(c) is not None else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )
