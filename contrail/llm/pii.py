"""Personal data: pattern spans, and terms that disclose them (DataFrame functions only).

Base spans (email, ip, card, phone) come from patterns. The information-theoretic part asks
which terms give a protected value away: with N different texts, a value e in df(e) of them,
a term t in df(t), both anywhere in df(e, t), the term carries
PMI(e; t) = log2(df(e, t) N / (df(e) df(t))) of the IC(e) = log2(N / df(e)) bits that identify
e. A term whose share PMI / IC reaches ``remove_at`` is removed, from ``generalise_at`` on it
is generalised, wherever it stands. Values and terms must meet in texts that count for
``min_joint`` independent ones, so a term met once is no evidence, nor are the rare words of a
group of near copies that share a value: texts with the same signature count as one kind, and
n texts with n_s of signature s count for n^2 / sum n_s^2.

Work: copies of a text count once (by hash). Only texts with a value that ``min_joint`` texts
share are paired, and only with terms that can still qualify: a share of ``generalise_at``
needs df(t) <= df(e, t) (N / df(e)) ^ (1 - generalise_at), and the texts that hold a shared
value bound df(t) from below. The frequencies of the terms that are left are counted over all
texts with map-side aggregation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import cut, free_name

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns. A run is entered only at its first character (or where the last
#: match ended) and repetitions are possessive: the same matches without quadratic rescans.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]))(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"
TERM = r"\p{L}[\p{L}\p{M}'’-]{2,}"
BASE = "array<struct<kind:string,first:int,after:int,value:string>>"
SPAN = "array<struct<first:int,after:int,value:string>>"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blocks(items: Column) -> Column:
    """A not empty array in slices of about the root of its size: folds that append copy an array per item, so they run
    within slices, and over the slices (n sqrt n steps, not n^2)."""
    width = F.ceil(F.sqrt(F.size(items))).cast("int")
    return F.transform(F.sequence(F.lit(0), F.size(items) - 1, width), lambda i: F.slice(items, i + 1, width))


def found(text: Column, pattern: str | Column) -> Column:
    """All matches with code-point positions: array<struct<first,after,value>>."""
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    pieces = F.split(text, p, -1) if isinstance(pattern, str) else F.call_function("split", text, p, F.lit(-1))
    values = F.regexp_extract_all(text, p, F.lit(0))
    pairs = F.zip_with(F.slice(pieces, 1, F.size(values)), values, lambda a, v: F.struct(F.length(a).alias("gap"), v.alias("value")))

    def one(acc, x):
        first = acc["at"] + x["gap"]
        after = first + F.length(x["value"])
        return F.struct(after.alias("at"), F.concat(acc["out"], F.array(F.struct(
            first.alias("first"), after.alias("after"), x["value"].alias("value")))).alias("out"))

    def step(acc, block):
        return bind(F.aggregate(block, F.struct(acc["at"].alias("at"), F.array().cast(SPAN).alias("out")), one), lambda b: F.struct(
            b["at"].alias("at"), F.concat(acc["out"], F.array(b["out"])).alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
    located = bind(pairs, lambda v: F.aggregate(blocks(v), start, step, lambda acc: F.flatten(acc["out"])))
    return F.when(F.regexp_like(text, p), located).otherwise(F.array().cast(SPAN))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Every second digit from the right doubled (less 9 above 9): the sum is a multiple of 10."""
    def add(total, i):
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        twice = 2 * d
        return total + F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.regexp_like(value, F.lit(IP_PARTS))
    n = F.length(digits(value))
    if kind == "card":
        return F.when(n.between(16, 19), luhn(digits(value))).otherwise(F.lit(False))
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def of_kind(text: Column, kind: str) -> Column:
    kept = F.filter(found(text, PATTERNS[kind]), lambda m: valid(kind, m["value"]))
    return F.transform(kept, lambda m: F.struct(F.lit(kind).alias("kind"), m["first"].alias("first"), m["after"].alias("after"), m["value"].alias("value")))


def base_spans(text: Column) -> Column:
    """array<struct<kind,first,after,value>> by kind as listed, then start."""
    return F.concat(*[of_kind(text, k) for k in KINDS])


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda m: m["kind"] == kind)).cast("long")


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def signature(words: Column) -> Column:
    """The least hash of a text's runs of five words (fewer: of all of them): near copies mostly share it."""
    runs = F.sequence(F.lit(1), F.greatest(F.size(words) - 4, F.lit(1)))
    return F.array_min(F.transform(runs, lambda i: F.xxhash64(F.slice(words, i, 5))))


def valued_texts(texts: DataFrame) -> DataFrame:
    """``texts`` (h, text, base) that hold a value, each once: h, base, their terms and their signature. Written, so
    that patterns run over the corpus once."""
    words = texts.where(F.size("base") > 0).select("h", "base", terms_of(F.col("text")).alias("words"))
    return cut(words.select("h", "base", F.array_distinct("words").alias("terms"), signature(F.col("words")).alias("signature"))
               .dropDuplicates(["h"]), "pii-valued")


SALTS = 16


def by_term(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``rows`` (h, term, ...) joined with one row per term, a hot term's rows in several parts."""
    parts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part")
    salted = rows.withColumn("part", F.pmod(F.xxhash64("h"), F.lit(SALTS)).cast("int"))
    return salted.join(terms.select("*", parts), ["term", "part"]).drop("part")


def disclosing_terms(texts: DataFrame, min_joint: int, generalise_at: float, valued: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``texts`` (h, text, base) -> (term, share) of the disclosing terms, and (h, term) of the
    texts that hold a candidate term. ``valued``: what :func:`valued_texts` wrote of them."""
    entity = F.transform(F.col("base"), lambda m: F.concat_ws(":", m["kind"], F.lower(m["value"])))
    valued = (valued_texts(texts) if valued is None else valued).withColumn("entities", F.array_distinct(entity))
    holds = valued.select("h", "signature", F.explode("entities").alias("entity"))
    entities = holds.groupBy("entity").agg(F.count("*").alias("df_e")).where(F.col("df_e") >= min_joint)
    n = max(texts.select("h").distinct().count(), 2)
    # A share of ``generalise_at`` needs df_t <= df_et * spread. The texts with a value are a lower bound
    # of df_t, and df_e an upper one of df_et, so terms beyond that cannot qualify.
    spread = F.pow(F.lit(float(n)) / F.col("df_e"), F.lit(1 - generalise_at)) * (1 + 1e-9)
    shared = cut(holds.join(entities, "entity").withColumn("spread", spread), "pii-shared")
    said = valued.join(shared.select("h").distinct(), "h", "left_semi").select("h", F.explode("terms").alias("term"))
    around = valued.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df_near")).where(F.col("df_near") >= min_joint)
    pairs = shared.join(by_term(said, around), "h").where(F.col("df_near") <= F.col("df_e") * F.col("spread"))
    # Near copies share their signature: texts count for n^2 / sum n_s^2 independent ones (s: signatures).
    same = pairs.groupBy("entity", "term", "signature").agg(F.count("*").alias("n_s"), *[F.first(c).alias(c) for c in ("df_e", "spread", "df_near")])
    met = same.groupBy("entity", "term").agg(F.sum("n_s").alias("df_et"), F.sum(F.col("n_s") * F.col("n_s").cast("double")).alias("squares"),
                                             *[F.first(c).alias(c) for c in ("df_e", "spread", "df_near")])
    independent = F.col("df_et") * F.col("df_et").cast("double") >= min_joint * F.col("squares")
    joint = cut(met.where(independent & (F.col("df_near") <= F.col("df_et") * F.col("spread"))).drop("squares"), "pii-joint")

    def held(part: DataFrame, joint: DataFrame) -> DataFrame:
        """(h, term) of the texts in ``part`` that hold a term of ``joint``. The terms are stored first,
        so that their size is known and small sets are broadcast."""
        terms = cut(joint.select("term").distinct(), "pii-candidates")
        return cut(part.select("h", F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term")).join(terms, "term").distinct(), "pii-terms")

    # The same bound from one text in 8 (by hash) leaves out most common terms before all texts are read for them.
    some = held(texts.where(F.pmod(F.xxhash64("h"), F.lit(8)) == 0), joint).groupBy("term").agg(F.count("*").alias("df_some"))
    joint = cut(joint.join(some, "term", "left").where(F.coalesce("df_some", F.lit(0)) <= F.col("df_et") * F.col("spread"))
                .select("entity", "term", "df_e", "df_et"), "pii-joint")
    holding = held(texts, joint)
    df = holding.groupBy("term").agg(F.count("*").alias("df_t"))
    bits = F.log2(F.lit(float(n)) / F.col("df_e"))
    pmi = F.log2(F.col("df_et") * float(n) / (F.col("df_e") * F.col("df_t")))
    share = joint.join(df, "term").select("term", F.when(bits > 0, pmi / bits).otherwise(0.0).alias("share"))
    return share.groupBy("term").agg(F.max("share").alias("share")).where(F.col("share") >= generalise_at), holding


def personal_data(docs: DataFrame, text_col: str = "text", min_joint: int = 3, generalise_at: float = 0.75,
                  remove_at: float = 0.9) -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``docs`` plus ``base`` and ``spans``: array<struct<kind,first,after,value,label>>
    by kind (email, ip, card, phone, term), then start, in code points, end exclusive. Returns the
    frame and the names the added columns got (underscored where ``docs`` has them).

    Defined cases: NULL and empty texts have no spans; equal texts have equal spans; repeated
    rows come out as often as they went in; a term inside a base span is part of that span; an
    empty table gives an empty result.
    """
    names = {}
    for k in ("base", "spans", "h", "terms"):
        names[k] = free_name([*docs.columns, *names.values()], k)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.unhex(F.md5(text))  # 128 bits: a text gets the spans of its own
    texts = docs.select(key.alias("h"), text.alias("text"))
    valued = valued_texts(texts.withColumn("base", base_spans(F.col("text"))))
    share, holding = disclosing_terms(texts, min_joint, generalise_at, valued)
    per_text = (by_term(holding, cut(share, "pii-share")).groupBy("h")
                .agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias(names["terms"])))
    per_text = valued.select("h", F.col("base").alias(names["base"])).join(per_text, "h", "full").withColumnRenamed("h", names["h"])
    marked = docs.withColumn(names["h"], key).join(per_text, names["h"], "left").withColumn(
        names["base"], F.coalesce(F.col(names["base"]), F.array().cast(BASE)))
    terms = F.col(names["terms"])
    words = F.array_join(F.sort_array(F.map_keys(terms), False), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{M}'’-])(?:"), words, F.lit(r")(?![\p{L}\p{M}'’-])"))
    disclosed = F.when(F.size(terms) > 0, found(text, pattern)).otherwise(F.array().cast(SPAN))
    base = F.col(names["base"])
    meets = lambda t, b: (t["first"] < b["after"]) & (b["first"] < t["after"])
    ranges = F.when(F.size(base) > 0, F.transform(blocks(base), lambda part: F.struct(
        F.array_min(F.transform(part, lambda b: b["first"])).alias("first"), F.array_max(F.transform(part, lambda b: b["after"])).alias("after"),
        part.alias("part")))).otherwise(F.array())
    outside = bind(ranges, lambda r: F.filter(disclosed, lambda t: ~F.exists(r, lambda p: meets(t, p) & F.exists(p["part"], lambda b: meets(t, b)))))
    labels = F.create_map(*[F.lit(x) for k in KINDS for x in (k, f"[{k.upper()}]")])
    labelled = F.concat(
        F.transform(base, lambda m: F.struct(m["kind"].alias("kind"), m["first"].alias("first"), m["after"].alias("after"),
                                             m["value"].alias("value"), labels[m["kind"]].alias("label"))),
        F.transform(outside, lambda m: F.struct(
            F.lit("term").alias("kind"), m["first"].alias("first"), m["after"].alias("after"), m["value"].alias("value"),
            F.when(F.try_element_at(terms, F.lower(m["value"])) >= remove_at, F.lit("")).otherwise(F.lit("[TERM]")).alias("label"))))
    return marked.withColumn(names["spans"], labelled).drop(names["h"], names["terms"]), names


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["first"], m["after"])), ",")


def replaced(text: Column, ordered: Column) -> Column:
    """``text`` with the union of overlapping spans (first, tail = -after, label; in order) as the first one's label."""
    def one(acc, m):
        return F.struct(F.greatest(acc["at"], -m["tail"]).alias("at"), F.concat(acc["out"], F.array(F.struct(
            acc["at"].alias("before"), m["first"].alias("first"), m["label"].alias("label")))).alias("out"))

    def step(acc, block):
        def written_out(b):
            part = F.substring(text, acc["at"] + 1, b["at"] - acc["at"])
            pieces = lambda t: F.transform(b["out"], lambda m: F.when(m["first"] >= m["before"], F.concat(
                F.substring(t, m["before"] - acc["at"] + 1, m["first"] - m["before"]), m["label"])).otherwise(F.lit("")))
            return F.struct(b["at"].alias("at"), F.concat(acc["out"], F.array(bind(part, lambda t: F.array_join(pieces(t), "")))).alias("out"))

        start = F.struct(acc["at"].alias("at"), F.array().cast("array<struct<before:int,first:int,label:string>>").alias("out"))
        return bind(F.aggregate(block, start, one), written_out)

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(blocks(ordered), start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))


def sanitised(docs: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with every span replaced by its label (removed terms: nothing); where spans of
    different kinds overlap, their union is replaced by the label of the one that starts first
    (then the longer). Texts without spans, NULL included, come back unchanged."""
    found_in, n = personal_data(docs, text_col, **settings)
    text = F.col(f"`{text_col}`")
    ordered = F.array_sort(F.transform(F.col(n["spans"]), lambda m: F.struct(
        m["first"].alias("first"), (-m["after"]).alias("tail"), m["label"].alias("label"))))
    clean = F.when(F.size(F.col(n["spans"])) > 0, bind(ordered, lambda spans: replaced(text, spans))).otherwise(text)
    return found_in.withColumn(text_col, clean).select(*[F.col(f"`{c}`") for c in docs.columns])
