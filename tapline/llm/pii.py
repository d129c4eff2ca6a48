"""Personal data: pattern spans, and terms that reveal them by co-occurrence, in DataFrame functions only.

Base spans are e-mail addresses, IP addresses, payment cards and phone numbers, leftmost and non-overlapping per kind. The
patterns are written so that one left-to-right scan finds them: runs are entered at their start only and never given
back, so a long run of letters or digits costs its length once.

The values of base spans are the protected entities. Over all distinct texts of the corpus, a term's power to reveal an
entity is their pointwise mutual information PMI(t; e) = log2(N n(t,e) / (n(t) n(e))), and the most it can reveal is the
information of the entity itself, IC(e) = log2(N / n(e)). A term discloses the entity when PMI >= alpha IC and at least
`support` distinct texts hold both. A term that reveals all of it (PMI = IC) is removed, others are generalised. Terms
are runs of four letters or more, in lower case, outside base spans.

Entities held by fewer than `support` texts cannot pass and are left out before any term is looked at, so term and entity
meet only in texts of the few entities that repeat. Texts are not shuffled as long as the table of what they reveal is
small enough to be broadcast; Spark decides by its size. All counts are combined before they are shuffled.

Null texts count as empty. Texts are told apart by a 64-bit hash, so repeated rows count once in the statistics and get
the same spans. An input column with the name of a result column is replaced; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapline.llm.common import staged, table

_LABEL = "[A-Za-z0-9-]"
_LOCAL = "[A-Za-z0-9._%+-]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# A run is entered at its start, or where the last match ended.
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?=\.{_LABEL})(?:[A-Za-z0-9.-](?<!\.(?!{_LABEL})))++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[0-9 -](?<![ -](?![0-9]))(?<![ -][ -]))++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
TERM = r"\p{L}{4,}+"
KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<s: bigint, e: bigint, v: string>>"


@dataclass(frozen=True)
class Disclosure:
    """`alpha`: share of an entity's information that a term may not reveal; `support`: texts that must show it."""

    alpha: float = 0.95
    support: int = 3


def spans(text: Column, pattern: str) -> Column:
    """Start, end (code points, exclusive) and text of every match of a pattern.

    Lengths of the stretches between matches and of the matches are added up in blocks of 256, so that the growing
    arrays are short whatever the number of matches.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def of(both: Column) -> Column:
        m, p = both.getField("m"), both.getField("p")
        none = F.array().cast(SPAN)

        def one(acc: Column, i: Column) -> Column:
            s = acc.getField("at") + F.length(F.get(p, i))
            e = s + F.length(F.get(m, i))
            span = F.struct(s.cast("bigint").alias("s"), e.cast("bigint").alias("e"), F.get(m, i).alias("v"))
            return F.struct(e.cast("bigint").alias("at"), F.concat(acc.getField("out"), F.array(span)).alias("out"))

        def block(acc: Column, k: Column) -> Column:
            last = F.least(F.size(m) - 1, k * 256 + 255)
            inner = F.aggregate(F.sequence(k * 256, last), F.struct(
                acc.getField("at").alias("at"), none.alias("out")), one)
            # One pass over the block, whose sum and spans are then taken apart.
            return F.element_at(F.transform(F.array(inner), lambda x: F.struct(
                x.getField("at").alias("at"), F.concat(acc.getField("out"), F.array(x.getField("out"))).alias("out"))), 1)

        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
        blocks = F.sequence(F.lit(0), ((F.size(m) - 1) / 256).cast("int"))
        return F.flatten(F.aggregate(blocks, start, block).getField("out"))

    # An array of one, so that the two lists are made once.
    return F.coalesce(F.element_at(F.transform(F.array(F.struct(found.alias("m"), F.lit(0).alias("z"))), lambda x: F.when(
        F.size(x.getField("m")) > 0, F.element_at(F.transform(F.array(F.struct(
            x.getField("m").alias("m"), between.alias("p"))), of), 1))), 1), F.array().cast(SPAN))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        x = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = 2 * x - F.when(x > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _is_card(span: Column) -> Column:
    digits = _digits(span.getField("v"))
    return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each kind; a match that fails its check is dropped."""
    return {
        "email": F.when(F.contains(text, F.lit("@")), spans(text, EMAIL)).otherwise(F.array().cast(SPAN)),
        "ip": F.filter(spans(text, IP), lambda x: x.getField("v").rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")),
        "card": F.filter(spans(text, CARD), _is_card),
        "phone": F.when(F.contains(text, F.lit("+")), F.filter(spans(text, PHONE), lambda x: F.length(
            _digits(x.getField("v"))).between(9, 15))).otherwise(F.array().cast(SPAN)),
    }


def with_base(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumns({f"_{kind}": column for kind, column in base_spans(F.col(text)).items()})


def _values(kind: str) -> Column:
    def one(x: Column) -> Column:
        value = F.lower(x.getField("v")) if kind in ("email", "ip") else _digits(x.getField("v"))
        return F.concat(F.lit(f"{kind}:"), value)

    return F.transform(f"_{kind}", one)


def _entities() -> Column:
    """Distinct values of all base spans of a row, with their kinds."""
    return F.array_distinct(F.concat(*map(_values, KINDS)))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(
        F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, " ")).otherwise(text), F.lit(TERM),
        F.lit(0)), F.lower))


def revealing(texts: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """(_th, _terms): for each text (by hash) that holds some, the terms that disclose an entity, as (term, all).

    `texts` has the columns _th and _text; `all` says that the term reveals the entity entirely.
    """
    held = staged(with_base(texts, "_text").select("_th", _entities().alias("_e")).where(F.size("_e") > 0)
                  .select("_th", F.explode("_e").alias("_e")).distinct(), "entities")
    repeated = held.groupBy("_e").agg(F.count("*").alias("_ne")).where(F.col("_ne") >= rule.support)
    held = staged(held.join(repeated, "_e"), "entities")
    private = texts.join(held.select("_th").distinct(), "_th", "left_semi")
    near = private.select("_th", F.explode(_terms(F.col("_text"))).alias("_t")).distinct()
    count = F.lit(texts.agg(F.count_distinct("_th")).head()[0]).cast("double")
    # pmi >= alpha ic asks for n(t) <= n(t, e) (N / n(e))^(1 - alpha), and n(t, e) <= n(e). So a term of more private texts
    # than that discloses no such entity, and none at all if it has more than the most frequent entity allows.
    most = F.col("_ne") * F.pow(count / F.col("_ne"), F.lit(1 - rule.alpha)) * (1 + 1e-9)
    top = F.lit(held.agg(F.max(most)).head()[0]).cast("double")
    often = near.groupBy("_t").agg(F.count("*").alias("_n")).where(F.col("_n").between(rule.support, top))
    pairs = staged(near.join(often, "_t").join(held, "_th").where(F.col("_n") <= most).groupBy("_t", "_e").agg(
        F.count("*").alias("_nte"), F.first("_ne").alias("_ne")).where(F.col("_nte") >= rule.support), "pairs")
    wanted = staged(pairs.select("_t").distinct(), "terms")
    hits = staged(texts.select("_th", F.explode(_terms(F.col("_text"))).alias("_t")).join(wanted, "_t", "left_semi")
                  .distinct(), "hits")
    ic = F.log2(count / F.col("_ne"))
    pmi = F.log2(count * F.col("_nte") / (F.col("_nt") * F.col("_ne")))
    told = pairs.join(hits.groupBy("_t").agg(F.count("*").alias("_nt")), "_t").where(
        (ic > 0) & (pmi >= rule.alpha * ic)).groupBy("_t").agg(F.max(F.col("_nt") == F.col("_nte")).alias("_all"))
    return staged(hits.join(told, "_t").groupBy("_th").agg(F.collect_list(F.struct(
        F.col("_t").alias("t"), F.col("_all").alias("all"))).alias("_terms")), "revealing")


def find(docs: DataFrame, rule: Disclosure = Disclosure(), text_col: str = "text") -> DataFrame:
    """Add `pii`, an array of (kind, start, stop, value, action) by kind and start, to every row.

    Kinds are email, ip, card, phone and term; `action` is what a sanitiser does: mask, generalise or remove.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("_row"), text.alias("_text"),
                       F.xxhash64(text).alias("_th"))
    met = with_base(rows.join(revealing(rows.select("_th", "_text"), rule), "_th", "left"), "_text")
    base = F.concat(*(F.col(f"_{kind}") for kind in KINDS))
    names = F.transform("_terms", lambda x: x.getField("t"))
    sure = F.transform(F.filter("_terms", lambda x: x.getField("all")), lambda x: x.getField("t"))
    words = F.filter(spans(F.col("_text"), TERM), lambda x: F.array_contains(names, F.lower(x.getField("v"))) & ~F.exists(
        base, lambda b: (b.getField("s") < x.getField("e")) & (b.getField("e") > x.getField("s"))))
    found = met.withColumn("_term", F.when(F.col("_terms").isNotNull(), words).otherwise(F.array().cast(SPAN)))

    def listed(kind: str) -> Column:
        def one(x: Column) -> Column:
            action = F.lit("mask") if kind != "term" else F.when(
                F.array_contains(sure, F.lower(x.getField("v"))), "remove").otherwise("generalise")
            return F.struct(F.lit(kind).alias("kind"), x.getField("s").alias("start"), x.getField("e").alias("stop"),
                            x.getField("v").alias("value"), action.alias("action"))

        return F.transform(f"_{kind}", one)

    return found.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns if c.lower() != "pii"),
                        F.concat(*(listed(kind) for kind in (*KINDS, "term"))).alias("pii"))


def sanitise(found: DataFrame, text_col: str = "text", to: str = "clean_text") -> DataFrame:
    """Add the text with its `pii` taken out: base spans become [KIND], terms [TERM] or nothing.

    Of spans that overlap, the later ones are cut at the end of the earlier one.
    """
    ordered = F.array_sort("pii", lambda a, b: (a.getField("start") - b.getField("start")).cast("int"))

    def cut(acc: Column, x: Column) -> Column:
        label = F.when(x.getField("action") == "remove", "").otherwise(F.concat(F.lit("["), F.upper(x.getField("kind")), F.lit("]")))
        fresh = x.getField("start") >= acc.getField("at")
        before = F.substring(F.col(text_col), (acc.getField("at") + 1).cast("int"),
                             (x.getField("start") - acc.getField("at")).cast("int"))
        return F.struct(F.greatest(acc.getField("at"), x.getField("stop")).alias("at"), F.when(
            fresh, F.concat(acc.getField("out"), F.array(before, label))).otherwise(acc.getField("out")).alias("out"))

    whole = F.aggregate(ordered, F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias(
        "out")), cut, lambda acc: F.concat(F.array_join(acc.getField("out"), ""), F.substring(
            F.col(text_col), (acc.getField("at") + 1).cast("int"), F.length(text_col))))
    return found.withColumn(to, F.when(F.size("pii") == 0, F.col(text_col)).otherwise(whole))


def digests(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of the base spans and all spans as text."""
    found = find(docs.select("doc_id", "text"), rule)

    def joined(kinds: tuple[str, ...]) -> Column:
        return F.array_join(F.transform(F.filter("pii", lambda x: x.getField("kind").isin(*kinds)), lambda x: F.concat_ws(
            ":", x.getField("kind"), x.getField("start"), x.getField("stop"))), ",")

    def counted(kind: str) -> Column:
        return F.size(F.filter("pii", lambda x: x.getField("kind") == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(counted, KINDS), F.sha2(joined(KINDS), 256).alias("base_sha256"),
                        joined((*KINDS, "term")).alias("spans"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
