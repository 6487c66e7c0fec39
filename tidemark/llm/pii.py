"""Personal data, and the terms that would still give it away.

Patterns find emails, IP addresses, card and phone numbers. Each value found is a protected
entity e. A term t of a document that names e discloses it as far as it narrows e down: with
document counts, PMI(e; t) = log2(N n(e,t) / (n(e) n(t))) of the information content
IC(e) = log2(N / n(e)). A term that discloses a large share is removed, one that discloses
less but more than allowed is generalised. Counts are over all documents and whole texts.

Entities that stand in the same documents disclose alike, and are counted as one. As n(e,t) is
at most n(e), a term with n(t) above N^(1-s) n(e)^s cannot disclose a share s, and never meets e.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import passes, sieve, stored

# The kinds and their patterns. Runs are possessive and start at the end of
# the last match or where no longer run began, which finds the same and stays linear.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
TERM = r"\p{L}[\p{L}\p{N}]*+"

SUPPORT = 2  # documents in which a term must stand with an entity
CHUNK = 512  # matches of a text that are listed at a time
GENERALISE, REMOVE = 0.8, 0.95  # shares of the information content disclosed


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(back, i, 1).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def located(text: Column, pattern: str) -> Column:
    """Matches of a pattern with their code points: array of (start, stop, value).

    Splitting at the pattern gives the gaps between the matches; lengths add up to places.
    Places are listed in chunks, so that no long array grows match by match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap))
    none = "cast(array() as array<struct<start:int,stop:int,value:string>>)"

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        stop = start + F.length(pair["value"])
        match = F.struct(start.alias("start"), stop.alias("stop"), pair["value"].alias("value"))
        return F.struct(stop.alias("at"), F.concat(state["out"], F.array(match)).alias("out"))

    def add_chunk(state: Column, pairs: Column) -> Column:
        chunk = F.aggregate(pairs, F.struct(state["at"].alias("at"), F.expr(none).alias("out")), add)
        # An array of the one chunk, so that it is made once.
        return F.element_at(
            F.transform(
                F.array(chunk), lambda c: F.struct(c["at"].alias("at"), F.concat(state["out"], c["out"]).alias("out"))
            ),
            1,
        )

    pairs = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda value, gap: F.struct(gap.alias("gap"), value.alias("value")))
    chunks = F.transform(
        F.array(pairs),
        lambda all_: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / CHUNK).cast("int")),
            lambda n: F.slice(all_, n * CHUNK + 1, F.lit(CHUNK)),
        ),
    )[0]
    start = F.struct(F.lit(0).alias("at"), F.expr(none).alias("out"))
    return F.when(F.size(found) > 0, F.aggregate(chunks, start, add_chunk, lambda s: s["out"])).otherwise(F.expr(none))


def _valid_spans(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: valid(kind, s["value"]))


def _named(kind: str, order: int) -> Column:
    return F.transform(
        kind,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("order"),
            s["stop"].alias("stop"),
            F.lit(kind).alias("kind"),
            s["value"].alias("value"),
        ),
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), text_key, and one key of both, ``doc``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.md5(text.cast("binary"))
    doc = F.md5(F.concat_ws(":", key, F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).cast("binary"))
    return docs.select("doc_id", text.alias("text"), F.unhex(key).alias("text_key"), F.unhex(doc).alias("doc"))


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, doc and ``base``: (start, order, stop, kind, value), sorted."""
    rows = _keyed(docs)
    may = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+"))}
    for kind in KINDS:
        spans = located(F.when(may.get(kind, F.lit(True)), F.col("text")).otherwise(""), PATTERNS[kind])
        rows = rows.withColumn(kind, _valid_spans(kind, spans))
    named = [_named(kind, n) for n, kind in enumerate(KINDS)]
    return rows.select("doc_id", "text_key", "doc", F.sort_array(F.concat(*named)).alias("base"))


def entity_groups(base: DataFrame) -> DataFrame:
    """doc, entities (a key of those that stand in the same documents), n_e and rows.

    n_e is the number of rows that name each of them, ``rows`` those of this doc. Entities of
    fewer than ``SUPPORT`` documents are left out.
    """
    value = lambda m: (
        F.when(m["kind"] == "email", F.lower(m["value"])).when(m["kind"] == "ip", m["value"]).otherwise(_digits(m["value"]))
    )
    named = F.array_distinct(F.transform("base", lambda m: F.concat_ws(":", m["kind"], value(m))))
    each = base.select("doc", F.explode(named).alias("entity")).groupBy("doc", "entity").agg(F.count("*").alias("rows"))
    each = stored(each, "pii-entities")
    where = [F.bit_xor(F.xxhash64("doc", F.lit(n))) for n in (0, 1)]
    groups = each.groupBy("entity").agg(
        F.sum("rows").alias("n_e"), F.count("*").alias("docs"), F.struct(*where).alias("entities")
    ).where(F.col("docs") >= SUPPORT)
    return each.join(groups, "entity").groupBy("doc", "entities").agg(F.first("n_e").alias("n_e"), F.first("rows").alias("rows"))


def _terms(text: str) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda t: F.lower(t)))


def disclosing(docs: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """doc, term and share: what terms of the docs disclose of the entities that these name."""
    total = F.lit(float(max(n, 1)))
    most = groups.groupBy("doc").agg(F.max("n_e").alias("most"))
    counted = stored(
        docs.select(F.explode(_terms("text")).alias("term")).groupBy("term").agg(F.count("*").alias("n_t")).where(F.col("n_t") >= SUPPORT),
        "pii-terms",
    )
    may = lambda n_e: F.col("n_t") <= F.pow(total, 1 - GENERALISE) * F.pow(n_e, GENERALISE) * (1 + 1e-9)
    holding = sieve(most, "doc")
    held = (
        _keyed(docs)
        .where(passes(holding, F.col("doc")))
        .select("doc", F.explode(_terms("text")).alias("term"))
        .join(counted, "term")
        .distinct()
    )
    held = stored(held.join(most, "doc").where(may(F.col("most"))).drop("most"), "pii-held")
    met = stored(
        groups.join(held, "doc").where(may(F.col("n_e"))).select("doc", "entities", "term", "n_e", "n_t", "rows"), "pii-met"
    )
    content = F.log2(total / F.col("n_e"))
    pmi = F.log2(total * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    shares = (
        met.groupBy("entities", "term")
        .agg(F.sum("rows").alias("n_et"), F.count("*").alias("docs"), F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t"))
        .where((F.col("docs") >= SUPPORT) & (content > 0))
        .select("entities", "term", (pmi / content).alias("share"))
        .where(F.col("share") >= GENERALISE)
    )
    return met.join(shares, ["entities", "term"]).groupBy("doc", "term").agg(F.max("share").alias("share"))


def term_marks(docs: DataFrame, base: DataFrame, found: DataFrame) -> DataFrame:
    """doc and ``added``: marks at every place of the found terms that no base span overlaps."""
    found = stored(found, "pii-found")
    kind = F.when(F.col("share") >= REMOVE, "removed").otherwise("generalised")
    wanted = sieve(found, "doc")
    places = (
        _keyed(docs)
        .where(passes(wanted, F.col("doc")))
        .select("doc", F.explode(located(F.col("text"), TERM)).alias("t"))
        .select("doc", F.lower("t.value").alias("term"), "t.start", "t.stop")
        .join(found.select("doc", "term", kind.alias("kind")), ["doc", "term"])
        .select("doc", F.col("stop").alias("by"), F.lit(0).alias("until"), "start", "stop", "kind")
    )
    spans = base.where(passes(wanted, F.col("doc"))).select("doc", F.explode("base").alias("b"))
    # A span ends after a term starts, and starts before the term ends: it comes later at equal places.
    spans = spans.select("doc", F.col("b.start").alias("by"), F.col("b.stop").alias("until"), *(F.lit(None).cast(t).alias(c) for c, t in (("start", "int"), ("stop", "int"), ("kind", "string"))))
    before = Window.partitionBy("doc").orderBy("by", "until").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    free = places.unionByName(spans).withColumn("reached", F.max("until").over(before)).where("kind is not null and reached <= start")
    mark = F.struct("start", F.lit(len(KINDS)).alias("order"), "stop", "kind")
    return free.groupBy("doc").agg(F.collect_set(mark).alias("added"))


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_key, the counts of the base kinds, base_sha256,
    spans and ``marks`` (start, order, stop, kind) of all spans, sorted.

    A null text is empty. Counts n(.) are of rows, for whole texts; a term counts with an
    entity if at least ``SUPPORT`` documents (of different doc_id or text) hold both. Places of
    terms that overlap a base span are left to it. Terms to be removed have kind ``removed``,
    those to be replaced by a class ``generalised``; both at all their places, but only in
    documents that name the entity. Rows that repeat doc_id and text have the same result.
    Other columns of ``docs`` are not looked at. The work grows with the length of a text, and
    not with the square of its mentions.
    """
    base = stored(base_spans(docs), "pii-base")
    naming = base.where(F.size("base") > 0)
    groups = stored(entity_groups(naming), "pii-groups")
    added = term_marks(docs, naming, disclosing(docs, groups, base.count()))
    own = F.transform(
        "base", lambda b: F.struct(b["start"].alias("start"), b["order"].alias("order"), b["stop"].alias("stop"), b["kind"].alias("kind"))
    )
    # Documents without base spans have no marks to meet; only the others are joined.
    blank, held = base.where(F.size("base") == 0), base.where(F.size("base") > 0)
    marked = held.join(added, "doc", "left").select(
        "doc_id", "text_key", "base", F.sort_array(F.concat(own, F.coalesce("added", F.array_except(own, own)))).alias("marks")
    )
    every = marked.unionByName(blank.select("doc_id", "text_key", "base", own.alias("marks")))
    joined = lambda marks: F.array_join(
        F.transform(marks, lambda m: F.concat_ws(":", m["kind"], m["start"], m["stop"])), ","
    )
    counts = [_count(kind) for kind in KINDS]
    return every.select(
        "doc_id",
        "text_key",
        *counts,
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("marks").alias("spans"),
        "marks",
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with its text rewritten: base spans become [KIND], generalised terms [TERM],
    removed terms go. Of spans that overlap the earlier and then longer one counts."""
    keyed = docs.withColumn("_key", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    found = personal_data(docs).where(F.size("marks") > 0).dropDuplicates(["doc_id", "text_key"])
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), "marks")
    joined = keyed.join(found, keyed.doc_id.eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_text")), "left")

    def step(state: Column, m: Column) -> Column:
        label = (
            F.when(m["kind"] == "removed", "")
            .when(m["kind"] == "generalised", "[TERM]")
            .otherwise(F.concat(F.lit("["), F.upper(m["kind"]), F.lit("]")))
        )
        piece = F.concat(F.substring(F.col("text"), state["at"] + 1, m["start"] - state["at"]), label)
        new = m["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], m["stop"]).alias("at"),
            F.when(new, F.concat(state["out"], F.array(piece))).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(F.col("text"), s["at"] + 1, F.length("text")))
    text = F.when(F.col("marks").isNull(), F.col("text")).otherwise(F.aggregate("marks", start, step, rest))
    return joined.withColumn("text", text).select(*docs.columns)
