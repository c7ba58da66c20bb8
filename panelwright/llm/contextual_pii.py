"""Personal data: base patterns, and identifiers that bootstrapped contexts reveal.

*Base.* Email addresses, IP addresses, card and phone numbers by fixed patterns over whole texts, leftmost and without
overlaps, each kind by itself; matches that fail their kind's test are dropped. The patterns below find exactly these
matches in time linear in the text: a match can only start where a run of its characters does, or where the match before
it ended, and nothing is repeated without bound but single characters. (A domain of over ``LABELS`` labels is found in
parts, which are put together again.)

*Bootstrap.* Base matches are seeds. Their surroundings give lexical patterns: the two words before, the word before and
the word behind, the two words behind, in lower case and with 9 for every digit. Other words that look like identifiers
(``DIGITS`` digits or an ``@``) have such patterns too. The graph of patterns and different identifiers is scored in
rounds: a pattern's confidence for a kind is the sum of its identifiers' scores over their number plus one, and counts
from ``SUPPORT`` identifiers and ``CONFIDENT`` thousandths on; an identifier's score is 1 - product(1 - confidence) over its
patterns, and it is accepted from ``ACCEPTED`` thousandths on, for its best kind. Accepted identifiers support patterns in
the next round. Every place of an accepted identifier is a span of its kind; base spans stay. Scores are whole numbers,
so their sums do not depend on any order.

Only DataFrame functions are used. Rows per text come together by text only; patterns and identifiers by sums.

NULL texts are empty and have no spans. A NULL ``doc_id`` stays NULL. Equal rows have equal results; texts of one
``doc_id`` are told apart by two 64-bit hashes. Extra columns are ignored. An empty table gives an empty result. The counts
``n_email`` to ``n_phone`` are those of base spans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import matched, text_or_empty
from panelwright.session import cut_lineage

KINDS = ["email", "ip", "card", "phone"]
LABELS = 1000
DIGITS = 6
SUPPORT = 3
CONFIDENT = 700
ACCEPTED = 900
ROUNDS = 3
CONTEXT = 60

WHITE, SOLID = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_REST = rf"(?:\.{_LABEL}++){{1,{LABELS}}}"
PATTERNS = {
    "email": rf"(?!\A)\G{_REST}|(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++{_REST}",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IDENTIFIER = rf"(?<!{SOLID})(?={SOLID}*@|(?:[^\x20\x09-\x0D0-9]*+[0-9]){{{DIGITS}}}){SOLID}++"
OTHER = len(KINDS)
KEY = ["doc_id", "th", "tu"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.xxhash64(F.lit(2), text).alias("tu"), text.alias("text"))


def _luhn(digits: Column) -> Column:
    """Whether up to 19 digits have a check sum that is a multiple of ten."""
    back = F.reverse(digits)
    total = F.lit(0)
    for i in range(19):
        digit = F.coalesce(F.try_to_number(F.nullif(F.substring(back, i + 1, 1), F.lit("")), F.lit("9")).cast("int"), F.lit(0))
        total = total + (F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit) if i % 2 else digit)
    return total % 10 == 0


def _valid(kind: Column, text: Column) -> Column:
    digits = F.regexp_replace(text, "[^0-9]", "")
    short = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    octets = F.forall(short, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    return (
        F.when(kind == KINDS.index("email"), True)
        .when(kind == KINDS.index("ip"), octets)
        .when(kind == KINDS.index("card"), _luhn(digits))
        .when(kind == KINDS.index("phone"), F.length(digits).between(8, 15))
        .otherwise(True)
    )


def _found(docs: DataFrame) -> DataFrame:
    """(key, kind, i, before, match, left, right): every match, with the number of code points between it and the last one."""
    searches = [*(PATTERNS[k] for k in KINDS), IDENTIFIER]
    possible = [F.contains("text", F.lit("@")), F.lit(True), F.lit(True), F.contains("text", F.lit("+")), F.lit(True)]
    none = F.lit(None).cast("array<string>")
    own = _keyed(docs)
    own = own.select("*", *[F.when(p, F.regexp_extract_all("text", F.lit(s), F.lit(0))).otherwise(none).alias(f"m{i}") for i, (s, p) in enumerate(zip(searches, possible, strict=True))])
    own = own.select("*", *[F.when(F.size(f"m{i}") > 0, F.split("text", s, -1)).otherwise(none).alias(f"s{i}") for i, s in enumerate(searches)])

    def rows(kind: int) -> Column:
        pieces = F.col(f"s{kind}")

        def row(match, i):
            left, right = F.get(pieces, i), F.get(pieces, i + 1)
            return F.struct(
                F.lit(kind).alias("kind"), i.alias("i"), F.length(left).cast("long").alias("before"), match.alias("match"),
                F.substring(left, -CONTEXT, CONTEXT).alias("left"), F.substring(right, 1, CONTEXT).alias("right"),
            )

        return F.when(F.size(pieces) > 0, F.transform(f"m{kind}", row)).otherwise(F.array())

    every = own.select(*KEY, F.explode(F.concat(*[rows(i) for i in range(len(searches))])).alias("_m")).select(*KEY, "_m.*")
    return every.dropDuplicates([*KEY, "kind", "i"])


def mentions(docs: DataFrame) -> DataFrame:
    """(key, kind, start, end, text, left, right) of base matches and of the identifiers that overlap none (kind ``OTHER``)."""
    place = Window.partitionBy(*KEY, "kind").orderBy("i")
    size = F.length("match").cast("long")
    found = _found(docs).select("*", F.sum(F.col("before") + size).over(place).alias("end"), size.alias("n"))
    # A part of a long domain belongs to the address before it.
    starts = (F.col("kind") != KINDS.index("email")) | F.contains("match", F.lit("@"))
    found = found.select("*", F.sum(starts.cast("int")).over(place).alias("_whole"))
    parts = F.sort_array(F.collect_list(F.struct("i", "match")))
    whole = found.groupBy(*KEY, "kind", "_whole").agg(
        F.min(F.col("end") - F.col("n")).alias("start"), F.max("end").alias("end"), parts["match"].alias("_parts"), F.min_by("left", "i").alias("left"), F.max_by("right", "i").alias("right")
    )
    whole = whole.select(*KEY, "kind", "start", "end", F.concat_ws("", "_parts").alias("text"), "left", "right")
    # Identifiers are looked at without the marks around them.
    core = F.regexp_replace(F.regexp_replace("text", r"\A[^A-Za-z0-9+]+", ""), r"(?<=[A-Za-z0-9])[^A-Za-z0-9]++\z", "")
    lead = F.length(F.regexp_extract("text", r"\A[^A-Za-z0-9+]*", 0)).cast("long")
    other = F.col("kind") == OTHER
    whole = whole.select(
        *KEY, "kind", F.when(other, F.col("start") + lead).otherwise(F.col("start")).alias("start"),
        F.when(other, F.col("start") + lead + F.length(core)).otherwise(F.col("end")).alias("end"), F.when(other, core).otherwise(F.col("text")).alias("text"), "left", "right",
    )
    whole = whole.where(_valid(F.col("kind"), F.col("text")) & (F.col("end") > F.col("start")))
    order = Window.partitionBy(*KEY).orderBy("start")
    before, behind = order.rangeBetween(Window.unboundedPreceding, 0), order.rangeBetween(0, Window.unboundedFollowing)
    base = F.col("kind") != OTHER
    whole = whole.select("*", F.max(F.when(base, F.col("end"))).over(before).alias("_until"), F.min(F.when(base, F.col("start"))).over(behind).alias("_from"))
    clear = (F.coalesce("_until", F.lit(0)) <= F.col("start")) & (F.coalesce("_from", F.col("end")) >= F.col("end"))
    return whole.where(base | clear).drop("_until", "_from")


def lexical_patterns(found: DataFrame) -> DataFrame:
    """(pattern, identifier, kind): each pattern with the different identifiers that it surrounds."""
    plain = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "9")
    words = lambda c: F.regexp_extract_all(plain(c), F.lit(f"{SOLID}+"), F.lit(0))
    own = found.select(F.lower("text").alias("identifier"), "kind", words("left").alias("l"), words("right").alias("r"))
    edge = F.lit("^")
    before = lambda i: F.coalesce(F.try_element_at("l", F.lit(-i)), edge)
    behind = lambda i: F.coalesce(F.try_element_at("r", F.lit(i)), edge)
    shapes = [F.concat_ws(" ", before(2), before(1), F.lit("_")), F.concat_ws(" ", before(1), F.lit("_"), behind(1)), F.concat_ws(" ", F.lit("_"), behind(1), behind(2))]
    edges = own.select("identifier", "kind", F.explode(F.array(*shapes)).alias("pattern"))
    return edges.groupBy("pattern", "identifier").agg(F.min("kind").alias("kind"))


def bootstrap(edges: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confident: int = CONFIDENT, accepted: int = ACCEPTED) -> DataFrame:
    """(identifier, kind, score) of the identifiers that patterns reveal; ``edges`` as from ``lexical_patterns``."""
    edges = cut_lineage(edges, "pii-edges")
    totals = cut_lineage(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support), "pii-patterns")
    seeds = edges.where(F.col("kind") != OTHER).select("pattern", "kind", F.lit(1000).cast("long").alias("score"))
    unknown = edges.where(F.col("kind") == OTHER).select("pattern", "identifier")
    found = edges.sparkSession.createDataFrame([], "identifier string, kind int, score long")
    known = 0
    for _ in range(rounds):
        scored = seeds.unionByName(unknown.join(found, "identifier").select("pattern", "kind", "score"))
        sums = scored.groupBy("pattern", "kind").agg(F.sum("score").alias("s"), F.count(F.lit(1)).alias("c")).where(F.col("c") >= support)
        sums = sums.join(totals, "pattern").select("pattern", "kind", F.expr("s div (n + 1)").alias("confidence")).where(F.col("confidence") >= confident)
        sure = F.round(-F.log(1 - F.col("confidence") / 1000.0) * 1_000_000).cast("long")
        strong = cut_lineage(sums.select("pattern", "kind", sure.alias("w")), "pii-strong")
        votes = unknown.join(strong, "pattern").groupBy("identifier", "kind").agg(F.sum("w").alias("w"))
        best = votes.groupBy("identifier").agg(F.max(F.struct("w", (-F.col("kind")).alias("k"))).alias("b"))
        best = best.where(F.col("b.w") >= round(-math.log(1 - accepted / 1000) * 1_000_000))
        score = F.floor(1000 * (1 - F.exp(-F.col("b.w") / 1_000_000.0))).cast("long")
        found = cut_lineage(best.select("identifier", (-F.col("b.k")).alias("kind"), score.alias("score")), "pii-found")
        before, known = known, found.count()
        if known == before:
            break
    return found


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row; offsets in code points, ends exclusive."""
    found = cut_lineage(mentions(docs), "pii-mentions")
    revealed = bootstrap(lexical_patterns(found), **options).select("identifier", F.col("kind").alias("_kind"))
    base = found.where(F.col("kind") != OTHER).select(*KEY, "kind", "start", "end", F.lit(True).alias("base"))
    added = found.where(F.col("kind") == OTHER).withColumn("identifier", F.lower("text")).join(revealed, "identifier")
    spans = base.unionByName(added.select(*KEY, F.col("_kind").alias("kind"), "start", "end", F.lit(False).alias("base")))
    listed = F.sort_array(F.collect_list(F.struct("kind", "start", "end", "base")))
    counts = [F.count_if(F.col("base") & (F.col("kind") == i)).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    by_text = cut_lineage(spans.groupBy(*KEY).agg(*counts, listed.alias("_s")), "pii-spans")
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    rows = matched(_keyed(docs).drop("text"), by_text, KEY, "left").withColumn("_s", F.coalesce("_s", F.array().cast(by_text.schema["_s"].dataType)))
    counted = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counted, F.sha2(joined(F.filter("_s", lambda x: x["base"])).cast("binary"), 256).alias("base_sha256"), joined(F.col("_s")).alias("spans"))


def query(spark, sf_dir: str) -> DataFrame:
    return personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
