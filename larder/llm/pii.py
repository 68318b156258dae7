"""Personal data, and terms that give it away. DataFrame functions only.

Patterns find the base kinds. Terms that stand near a protected value are judged by what they tell about it: the share of
a term's documents in which it stands near the value, and the information in bits over the value's share of all
documents. Terms beyond both thresholds, seen in different contexts, are spans of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.tables import keyed, plain, written

# Patterns of the contract. Possessive repeats and the look behind change no match: no repeat could give anything back to
# what follows it, and within a run of a first class a later start matches only where the first one does. \G is the end
# of the match before, where a run may begin in the middle.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"  # shorter runs of digits fail in any case
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")
TERM = r"[\p{L}\p{N}]{3,}"

CONTEXT = 80  # code points on either side of a value
POSTERIOR = 0.5
BITS = 6.0
CONTEXTS = 2
BROADCAST_TERMS = 100_000


def running(sizes: Column) -> Column:
    """The sum of all entries before each one.

    Blocks of a fixed size first, then the blocks: building arrays entry by entry would copy them again and again.
    """
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(sizes).cast("double"))).cast("int"))
    n = F.ceil(F.size(sizes) / block).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.slice(sizes, k * block + 1, block))

    def before(values: Column) -> Column:
        none = F.array().cast("array<int>")
        start = F.struct(F.lit(0).alias("sum"), none.alias("all"))
        step = lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.array_append(s["all"], s["sum"]).alias("all"))
        return F.aggregate(values, start, step, lambda s: s["all"])

    sums = before(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x)))
    inner = F.zip_with(blocks, sums, lambda b, s: F.transform(before(b), lambda x: x + s))
    return F.when(F.size(sizes) == 0, F.array().cast("array<int>")).otherwise(F.flatten(inner))


def located(text: Column, pattern: Column, found: Column) -> Column:
    """Array of (start, stop, value), in code points, of ``found``, which are all matches of ``pattern`` in order."""
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
    ends = F.zip_with(running(steps), steps, lambda a, b: a + b)
    return F.zip_with(ends, found, lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("stop"), m.alias("value")))


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    backward = F.split(F.reverse(digits), "")

    def worth(x: Column, k: Column) -> Column:
        v = x.cast("int") * (1 + k % 2)
        return F.when(v > 9, v - 9).otherwise(v)

    return F.aggregate(F.transform(backward, worth), F.lit(0), lambda s, x: s + x) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


SPAN = "array<struct<start:int,kind:int,stop:int,value:string>>"


def base_spans(rows: DataFrame) -> DataFrame:
    """Adds ``base``: spans (start, kind, stop, value) in order, kind being a place in ``KINDS``."""
    hints = {"email": "@", "phone": "+"}
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    none = F.array().cast("array<string>")
    found = {
        kind: F.when(F.instr("text", hints[kind]) > 0, F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none)
        if kind in hints
        else F.regexp_extract_all("text", F.lit(p), F.lit(0))
        for kind, p in patterns.items()
    }
    rows = rows.withColumns({f"found_{kind}": column for kind, column in found.items()})

    def spans(no: int, kind: str) -> Column:
        at = located(F.col("text"), F.lit(patterns[kind]), F.col(f"found_{kind}"))
        good = F.filter(at, lambda s: passes(kind, s["value"]))
        shaped = F.transform(
            good, lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("kind"), s["stop"].alias("stop"), s["value"].alias("value"))
        )
        return F.when(F.size(f"found_{kind}") > 0, shaped.cast(SPAN)).otherwise(F.array().cast(SPAN))

    all_spans = F.array_sort(F.concat(*[spans(no, kind) for no, kind in enumerate(patterns)]))
    return rows.withColumn("base", all_spans).drop(*[f"found_{kind}" for kind in patterns])


def entity(span: Column) -> Column:
    """What a value protects: equal for different spellings."""
    plain_value = F.when(span["kind"] == 0, F.lower(span["value"])).when(span["kind"] == 1, span["value"])
    return F.concat(span["kind"].cast("string"), F.lit(":"), F.coalesce(plain_value, F.regexp_replace(span["value"], "[^0-9]", "")))


def disclosing_terms(rows: DataFrame, posterior: float = POSTERIOR, bits: float = BITS, contexts: int = CONTEXTS) -> DataFrame:
    """(term, entity, posterior, bits) of terms that reveal a protected value; counts are of documents, all of them."""
    # Values next to each other are no context of one another.
    s = F.col("span")
    left = F.substring("text", F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
    right = F.substring("text", s["stop"] + 1, F.lit(CONTEXT))
    near = rows.where(F.size("base") > 0).select("k1", "k2", "text", F.explode("base").alias("span"))
    near = near.select("k1", "k2", entity(s).alias("entity"), F.concat(left, F.lit(" "), right).alias("context"))
    words = F.array_distinct(F.regexp_extract_all("context", F.lit(TERM), F.lit(0)))
    pairs = near.select("k1", "k2", "entity", F.xxhash64("context").alias("context"), F.explode(words).alias("term"))
    # One row for each document first, so that neither long documents nor copies count twice; partial sums throughout.
    single = pairs.groupBy("entity", "term", "k1", "k2").agg(F.min("context").alias("low"), F.max("context").alias("high"))
    joint = single.groupBy("entity", "term").agg(F.count("*").alias("joint"), F.min("low").alias("low"), F.max("high").alias("high"))
    several = F.lit(contexts > 1) & (F.col("low") == F.col("high"))
    joint = written(joint.where((F.col("joint") >= contexts) & ~several), "pii-joint")
    entities = near.select("entity", "k1", "k2").distinct().groupBy("entity").agg(F.count("*").alias("df_entity"))
    frequency = term_rows(rows, joint.select("term").distinct()).groupBy("term").agg(F.count("*").alias("df_term"))
    total = rows.count()
    told = joint.join(frequency, "term").join(entities, "entity")
    share = F.col("joint") / F.col("df_term")
    gain = F.log2(share * F.lit(float(max(total, 1))) / F.col("df_entity"))
    return told.select("term", "entity", share.alias("posterior"), gain.alias("bits")).where((F.col("posterior") >= posterior) & (F.col("bits") >= bits))


def term_rows(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(k1, k2, term) for each of ``terms`` that a document has. Few terms go to all tasks, many are joined by shuffle."""
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)))
    single = rows.select("k1", "k2", F.explode(words).alias("term"))
    few = terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    return single.join(F.broadcast(terms) if few else terms, "term")


def shown(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def personal_data(docs: DataFrame, **thresholds) -> DataFrame:
    """doc_id, text, base (spans of the patterns) and all (those and revealing terms) of each row.

    Offsets are code points, ends exclusive. Null text is empty and has no spans. Rows that repeat get equal spans; they
    count once as documents where they are equal in id and text. A term within a base span isn't a span.
    """
    rows = written(base_spans(keyed(plain(docs))), "pii-base")
    flagged = written(disclosing_terms(rows, **thresholds).select("term").distinct(), "pii-terms")
    of_document = term_rows(rows, flagged).groupBy("k1", "k2").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    joined = rows.join(of_document, ["k1", "k2"], "left")
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join("terms", "|"), F.lit(r")(?![\p{L}\p{N}])"))
    joined = joined.withColumn("pattern", F.when(F.col("terms").isNotNull(), pattern))
    at = located(F.col("text"), F.col("pattern"), F.regexp_extract_all("text", F.col("pattern"), F.lit(0)))
    free = F.filter(at, lambda t: ~F.exists("base", lambda s: (s["start"] < t["stop"]) & (t["start"] < s["stop"])))
    more = F.transform(
        free, lambda s: F.struct(s["start"].alias("start"), F.lit(4).alias("kind"), s["stop"].alias("stop"), s["value"].alias("value"))
    )
    more = F.when(F.col("pattern").isNotNull(), more.cast(SPAN)).otherwise(F.array().cast(SPAN))
    return joined.select("doc_id", "text", "base", F.array_sort(F.concat("base", more)).alias("all"))


def sanitised(found: DataFrame) -> DataFrame:
    """doc_id and text with each span of ``personal_data`` replaced: values by their kind, terms by nothing."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS[:-1]], F.lit(""))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("done"))

    def step(s: Column, x: Column) -> Column:
        # Of overlapping spans of different kinds the first one counts.
        before = F.substring("text", s["done"] + 1, x["start"] - s["done"])
        new = F.struct(F.concat(s["out"], before, F.get(names, x["kind"])).alias("out"), x["stop"].alias("done"))
        return F.when(x["start"] >= s["done"], new).otherwise(s)

    clean = F.aggregate("all", start, step)
    done = found.select("doc_id", "text", clean.alias("s"))
    return done.select("doc_id", F.concat(F.col("s.out"), F.expr("substring(text, s.done + 1)")).alias("text"))


def of_kind(no: int):
    return lambda s: s["kind"] == no


def span_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of each row."""
    found = personal_data(docs)
    counts = [
        F.size(F.filter("base", of_kind(no))).cast("long").alias(f"n_{kind}") for no, kind in enumerate(KINDS[:-1])
    ]
    return found.select("doc_id", *counts, F.sha2(shown(F.col("base")).cast("binary"), 256).alias("base_sha256"), shown(F.col("all")).alias("spans"))

