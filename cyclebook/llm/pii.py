"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Regular expressions with checks give the base spans. They seed the bootstrapping: identifier-like
chunks of a text (runs of words with a digit or an at sign) are instances, the words before a
chunk with its rough number of digits are lexical patterns. Patterns and instances score each other over a
few rounds on their graph, and chunks in patterns that nearly always hold one kind of identifier
are taken for that kind, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cyclebook.llm.shared import apart, staged

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_SEEDS = 5  # distinct seed instances that a pattern needs
MIN_CONFIDENCE = 0.8
CONTEXT = 64  # characters before a chunk that hold its context words

# The contract's patterns, put so that they never retry from inside a run and never recurse: a
# match begins where the last one ended or where a run begins, and ends are found by lookahead.
_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@(?=[{_HOST}]++\.[{_HOST}])[{_HOST}.]+?"
             rf"(?=\.(?![{_HOST}])|[^{_HOST}.]|\z)",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?=[\x20-]?[0-9])[0-9\x20-]+?(?=[\x20-](?![0-9])|[^0-9\x20-]|\z)",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Up to eight words in a row that each hold a digit or an at sign.
_WORD = r"(?=[^\s0-9@]*+[0-9@])\S++"
CHUNK = rf"(?<!\S){_WORD}(?:\x20{_WORD}){{0,7}}"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of ten."""
    worth = F.transform(F.split(F.reverse(digits), "(?!^)(?!$)"), lambda d, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)
    ).otherwise(d.cast("int")))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0


def is_valid(kind: Column, found: Column) -> Column:
    """Whether a match of a kind's pattern passes that kind's check."""
    digits = _digits(found)
    n = F.length(digits)
    return (F.when(kind == "email", F.lit(True))
            .when(kind == "ip", found.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
            .when(kind == "card", F.when(n.between(16, 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(8, 15)).otherwise(False))


def _matches(text: Column, kind: str, pattern: str, worth: Column) -> Column:
    """Matches of a pattern from left to right, each with the text's length since the one before."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.zip_with(between, found, lambda gap, m: F.struct(
        F.length(gap).alias("gap"), F.right(gap, F.lit(CONTEXT)).alias("before"), m.alias("found")))
    rows = F.transform(rows, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("pos"), x["gap"].alias("gap"), x["before"].alias("before"),
        x["found"].alias("found")))
    rows = F.filter(rows, lambda x: x["found"].isNotNull())
    return F.when(worth, rows)


def _keyed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row's key: its id and a hash of its text; equal rows have equal spans."""
    return documents.withColumns({
        "__id": F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))),
        "__hash": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})


def _scan(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Every match and chunk: ``__id, __hash, kind, start, end, found, before``, staged.

    The one pass over the texts. Places in a text are running sums over its own matches.
    """
    t = F.col("t")
    digit = t.rlike("[0-9]")
    worth = {"email": F.contains(t, F.lit("@")), "ip": digit, "card": digit,
             "phone": F.contains(t, F.lit("+")), "chunk": digit | F.contains(t, F.lit("@"))}
    found = [_matches(t, k, p, worth[k]) for k, p in {**PATTERNS, "chunk": CHUNK}.items()]
    rows = (_keyed(documents.select(F.col(doc_id).alias("d"), F.col(text).alias("t")), "d", "t")
            .filter(digit | worth["email"])
            .select("__id", "__hash", F.explode(F.flatten(F.array_compact(F.array(*found)))).alias("m"))
            .select("__id", "__hash", "m.*"))
    # Rows that repeat an id and a text give the same matches again.
    once = rows.groupBy("__id", "__hash", "kind", "pos").agg(
        *[F.min(c).alias(c) for c in ("gap", "before", "found")])
    upto = F.sum(F.col("gap") + F.length("found")).over(
        Window.partitionBy("__id", "__hash", "kind").orderBy("pos"))
    once = once.withColumn("end", upto).withColumn("start", F.col("end") - F.length("found"))
    return staged(once.select("__id", "__hash", "kind", "start", "end", "found", "before"), "matches")


def _holds(kind: str) -> Column:
    """Whether a chunk holds a valid match of a kind."""
    hits = F.regexp_extract_all("core", F.lit(PATTERNS[kind]), F.lit(0))
    return F.exists(hits, lambda m: is_valid(F.lit(kind), m))


def chunk_instances(matches: DataFrame) -> DataFrame:
    """Chunks without surrounding punctuation, with the kind they are a seed of and their patterns."""
    lead = F.regexp_extract("found", r"^[^0-9A-Za-z+@(\x80-\x{10FFFF}]*", 0)
    core = F.regexp_replace(F.expr("substr(found, length(lead) + 1)"), r"[^0-9A-Za-z\x80-\x{10FFFF}]+$", "")
    chunks = (matches.filter("kind = 'chunk'").withColumn("lead", lead).withColumn("core", core)
              .filter("core != ''")
              .withColumn("start", F.col("start") + F.length("lead"))
              .withColumn("end", F.col("start") + F.length("core")))
    seed = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        seed = F.when(_holds(kind), F.lit(kind)).otherwise(seed)
    n_digits = F.length(_digits(F.col("core")))
    size = F.when(F.contains("core", F.lit("@")), F.lit("@")).otherwise(
        F.when(n_digits < 4, F.lit("9")).when(n_digits < 8, F.lit("9999")).when(n_digits < 16, F.lit("9{8}"))
        .otherwise(F.lit("9{16}")))
    words = F.regexp_extract_all(F.lower("before"), F.lit(r"\S+"), F.lit(0))
    one = F.concat(F.lit("1 "), F.element_at("w", -1))
    two = F.concat(F.lit("2 "), F.element_at("w", -2), F.lit(" "), F.element_at("w", -1))
    n = F.size("w")
    return (chunks.withColumn("seed", seed).withColumn("size", size).withColumn("w", words)
            .withColumn("contexts", F.when(n > 1, F.array(one, two)).when(n == 1, F.array(one)).otherwise(F.array(F.lit("0"))))
            .select("__id", "__hash", "start", "end", F.md5(F.lower("core").cast("binary")).alias("instance"), "seed",
                    F.transform("contexts", lambda c: F.concat(c, F.lit(" "), F.col("size"))).alias("patterns")))


def pattern_confidence(edges: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS,
                       min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``pattern, kind, confidence`` of the patterns to trust, from ``edges(pattern, instance, seed)``.

    An instance that is a seed counts fully for its kind. Of the others each counts as much as
    the trusted patterns it occurs in vouch for it, and from ``min_confidence`` on as a seed of the
    next round, so that patterns without any base match come in; a pattern's confidence is the mean of its
    instances. Each edge is there once, so a pattern or instance with very many occurrences is as
    many rows as it has distinct partners, and sums are partial before they are shuffled.
    """
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    seeds = edges.filter("seed is not null").select(
        "pattern", F.col("seed").alias("kind"), F.lit(1.0).alias("trust"), F.lit(1).alias("is_seed"))
    others = edges.filter("seed is null").select("pattern", "instance")
    known, trusted = seeds, None
    for k in range(rounds):
        mass = known.groupBy("pattern", "kind").agg(F.sum("trust").alias("mass"), F.sum("is_seed").alias("seeds"))
        trusted = (mass.filter(F.col("seeds") >= min_seeds).join(sizes, "pattern")
                   .withColumn("confidence", F.col("mass") / F.col("n"))
                   .filter(F.col("confidence") >= min_confidence).select("pattern", "kind", "confidence"))
        trusted = staged(trusted, "trusted-patterns")
        if k + 1 < rounds:
            doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
            vouched = others.join(trusted, "pattern").groupBy("instance", "kind").agg((1 - doubt).alias("trust"))
            known = seeds.unionAll(others.join(vouched, "instance")
                                   .select("pattern", "kind", "trust",
                                           (F.col("trust") >= min_confidence).cast("int").alias("is_seed")))
    return trusted


def find_spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``__id, __hash, kind, start, end, base`` of all spans: code points, end exclusive.

    Base spans are the valid matches of ``PATTERNS``; the others are chunks without any base span
    in trusted patterns, and never overlap a base span.
    """
    matches = _scan(documents, doc_id, text)
    base = (matches.filter(F.col("kind").isin(*KINDS)).filter(is_valid(F.col("kind"), F.col("found")))
            .select("__id", "__hash", "kind", "start", "end", F.lit(True).alias("base")))
    chunks = staged(chunk_instances(matches), "chunks")
    edges = staged(chunks.select(F.explode("patterns").alias("pattern"), "instance", "seed")
                   .distinct(), "pattern-graph")
    trusted = pattern_confidence(edges)
    best = F.max(F.struct("confidence", "kind")).alias("best")
    new = (chunks.filter("seed is null").withColumn("pattern", F.explode("patterns")).join(trusted, "pattern")
           .groupBy("__id", "__hash", "start", "end").agg(best)
           .select("__id", "__hash", F.col("best.kind").alias("kind"), "start", "end", F.lit(False).alias("base")))
    near = base.join(new.select("__id", "__hash").distinct(), ["__id", "__hash"], "left_semi").unionAll(new)
    order = Window.partitionBy("__id", "__hash").orderBy("start", "end", "kind")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    clear = (near.withColumn("left", before).withColumn("right", after)
             .filter("not base and coalesce(`left` <= start, true) and coalesce(`right` >= end, true)")
             .drop("left", "right"))
    return base.unionAll(clear.select(*base.columns))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["no"] + 1), s["start"], s["end"])), ",")


def personal_data(documents: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of each row of documents.

    The counts and the digest are those of the base spans. Null and empty texts have no spans,
    repeated rows the same ones each. An empty table gives an empty one; columns other than
    doc_id and text are not read. A document's own spans meet in one row, nothing else does.
    """
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    spans = (find_spans(documents).groupBy("__id", "__hash")
             .agg(F.sort_array(F.collect_list(F.struct(number.alias("no"), "start", "end", "base"))).alias("all")))
    rows = _keyed(documents.select("doc_id", "text"), "doc_id", "text").drop("text")
    found = rows.join(spans, ["__id", "__hash"], "left").withColumn(
        "all", F.coalesce("all", F.array().cast("array<struct<no:int,start:bigint,end:bigint,base:boolean>>")))
    found = found.withColumn("of_base", F.filter("all", lambda s: s["base"]))
    numbers = F.transform("of_base", lambda s: s["no"])
    counts = [(F.size(numbers) - F.size(F.array_remove(numbers, i))).cast("long").alias(f"n_{k}")
              for i, k in enumerate(KINDS)]
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), *counts,
                        F.sha2(_listed(F.col("of_base")), 256).alias("base_sha256"),
                        _listed(F.col("all")).alias("spans"))


def redact(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with every span of personal data replaced by its kind in brackets.

    Overlapping spans are replaced as one, by the kind of the first. Nulls stay null; all columns
    keep their names, whatever these are, and order.
    """
    names, documents = documents.columns, apart(documents, doc_id, text)
    spans = (find_spans(documents, doc_id, text).groupBy("__id", "__hash")
             .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("__spans")))
    t = F.col(text)
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("long").alias("at"))
    part = lambda a, b: F.substring(t, (a + 1).cast("int"), (b - a).cast("int"))
    walked = F.aggregate("__spans", empty, lambda acc, s: F.when(s["start"] < acc["at"], F.struct(
        acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(F.struct(
            F.concat(acc["out"], F.array(part(acc["at"], s["start"]), F.concat(F.lit("["), s["kind"], F.lit("]")))).alias("out"),
            s["end"].alias("at"))))
    joined = _keyed(documents, doc_id, text).join(spans, ["__id", "__hash"], "left").withColumn("__w", walked)
    rest = F.substring(t, (F.col("__w.at") + 1).cast("int"), F.length(t))
    clean = F.when(F.col("__spans").isNull(), t).otherwise(F.concat(F.array_join("__w.out", ""), rest))
    return joined.select(*[clean.alias(c) if c == text else F.col(c) for c in documents.columns]).toDF(*names)
