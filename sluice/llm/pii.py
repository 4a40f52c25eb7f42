"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Patterns find e-mail addresses, IP addresses, card and phone numbers. Secrets are found by context: a
cue is a word that stands before ``=`` or ``:`` and long values of letters and digits, and that the
corpus shows to be followed by ever new ones, so that it says little about the value and the value tells
much; its values are secrets wherever they stand. Each distinct value is a protected entity, and so is
each kind of them. Terms (runs of three letters or more) on the lines of an entity are counted over the
corpus: a term discloses an entity as far as its pointwise mutual information with the entity comes
near the entity's own information. Terms above the threshold are spans of kind ``term`` in documents
that hold the entity. Sanitising generalises spans of entities to their kind, and terms that disclose no
more than a kind to ``[TERM]``; terms that disclose a single entity are removed.

Java evaluates a repeated group by recursion, so a long match could exhaust the stack. The patterns
therefore run on texts in which separators that cannot belong to a match are first replaced by a
neutral character of the same length; what is left needs no repeated group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import saved

KINDS = ("email", "ip", "card", "phone")
_TERM = r"\p{L}{3,}"
#: A value that may be a secret, and a cue before one; a secret holds letters and digits.
_VALUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9][A-Za-z0-9+/_-]{11,}+"
_CUED = r"\p{L}[\p{L}_-]{1,29}[\x20\t]{0,3}[=:][\x20\t]{0,3}[\x22\x27]?[A-Za-z0-9][A-Za-z0-9+/_-]{11,}+"
#: An entity that stands for all values of a kind, and how far before a value its cue may end.
_ANY, _NEXT_TO = "any ", 12


def _matches(kind: str, text: Column, pattern: str) -> Column:
    """Structs ``(kind, gap, value)``: each match and the code points between it and the one before."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))
    return F.transform(F.filter(parts, lambda z: z["value"].isNotNull()), lambda z: F.struct(F.lit(kind).alias("kind"), F.length(z["gap"]).alias("gap"), z["value"].alias("value")))


def _may_hold(text: Column) -> dict[str, Column]:
    """Per kind what a text must show to hold one; cheap beside the search itself."""
    return {
        "email": text.contains("@"),
        "ip": text.rlike(r"[0-9]\.[0-9]+\.[0-9]"),
        "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
        "phone": text.rlike(r"\+[0-9]"),
        "secret": text.rlike("[0-9][A-Za-z]|[A-Za-z][0-9]"),
    }


def _digits(value: str) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: str) -> Column:
    """Whether the digits pass the Luhn check."""
    digits = F.split(F.reverse(_digits(value)), "")
    doubled = lambda d, i: F.when(i % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)
    total = F.aggregate(F.transform(digits, lambda c, i: doubled(c.cast("int"), i)), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def _placed(rows: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``start`` and ``end`` (code points, end exclusive) from gaps and values in order of ``i``."""
    order = Window.partitionBy(*by).orderBy("i")
    end = F.sum(F.col("gap") + F.length("value")).over(order)
    return rows.withColumn("end", end.cast("int")).withColumn("start", F.col("end") - F.length("value"))


def pattern_spans(rows: DataFrame) -> DataFrame:
    """``(tag, kind, start, end, value)`` of valid pattern matches in rows ``(tag, text)``."""
    text = F.col("text")
    may = _may_hold(text)
    loose = F.regexp_replace(text, r"\.(?![A-Za-z0-9-])|(?<![A-Za-z0-9-])\.", "_")
    joined = F.regexp_replace(text, r"[\x20-](?![0-9])|(?<![0-9])[\x20-]", "x")
    none = F.array().cast("array<struct<kind:string,gap:int,value:string>>")
    found = F.concat(
        F.when(may["email"], _matches("email", loose, r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++")).otherwise(none),
        F.when(may["ip"], _matches("ip", text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")).otherwise(none),
        F.when(may["card"], _matches("card", joined, r"(?<![0-9])[0-9][0-9\x20-]++")).otherwise(none),
        F.when(may["phone"], _matches("phone", text, r"\+[0-9][\x20().0-9-]+[0-9]")).otherwise(none),
    )
    # Equal rows have equal tags and are searched once.
    each = rows.where(text.rlike("[0-9@]")).select("tag", F.posexplode(found).alias("i", "m")).select("tag", "i", "m.*").dropDuplicates(["tag", "i"])
    placed = _placed(each, ["tag", "kind"])
    size = F.length(_digits("value"))
    small = F.forall(F.split("value", r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike(r"^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    valid = (
        (F.col("kind") == "email")
        | (F.col("kind") == "ip") & small
        | (F.col("kind") == "card") & size.between(13, 19) & _luhn("value")
        | (F.col("kind") == "phone") & size.between(9, 15)
    )
    return placed.where(valid).select("tag", "kind", "start", "end", "value")


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def secret_spans(rows: DataFrame, least_values: int = 3, most_repeats: float = 2.0) -> DataFrame:
    """``(tag, kind, start, end, value)`` of secrets in rows ``(tag, text)``.

    A cue counts when ``least_values`` different values of letters and digits follow it, when they are
    at least half of all that follows it, and when its distinct lines are at most ``most_repeats`` times
    its values: what follows is then as good as new each time. Values of such cues are secrets in every
    text that holds them, with a cue or without.
    """
    text = F.col("text")
    # Looked for in texts that can hold them alone: these patterns cost much at every word.
    lines = rows.where((text.contains("=") | text.contains(":")) & text.rlike(_CUED)).select(F.explode(F.split("text", "\n", -1)).alias("words")).where(F.col("words").rlike(_CUED))
    each = lines.select(F.xxhash64("words").alias("print"), F.explode(F.regexp_extract_all("words", F.lit(_CUED), F.lit(0))).alias("m"))
    cue = F.lower(F.regexp_extract("m", r"^\p{L}[\p{L}_-]*", 0))
    each = each.select("print", cue.alias("cue"), F.regexp_extract("m", r"[A-Za-z0-9][A-Za-z0-9+/_-]*$", 0).alias("value")).distinct()
    per_value = each.groupBy("cue", "value").agg(F.count("*").alias("n"))
    good = per_value.groupBy("cue").agg(F.sum("n").alias("lines"), F.count("*").alias("values"), F.count_if(_mixed(F.col("value"))).alias("mixed"))
    good = good.where((F.col("mixed") >= least_values) & (2 * F.col("mixed") >= F.col("values")) & (F.col("lines") <= most_repeats * F.col("values")))
    values = saved(per_value.where(_mixed(F.col("value"))).join(good.select("cue"), "cue", "left_semi").select("value").distinct(), "secrets")
    found = rows.where(_may_hold(text)["secret"] & text.rlike(_VALUE)).select("tag", F.posexplode(_matches("secret", text, _VALUE)).alias("i", "m"))
    placed = _placed(found.select("tag", "i", "m.*").dropDuplicates(["tag", "i"]), ["tag"])
    return placed.where(_mixed(F.col("value"))).join(values, "value", "left_semi").select("tag", "kind", "start", "end", "value")


def disclosing_terms(
    rows: DataFrame, spans: DataFrame, least_lines: int = 3, least_share: float = 0.5, least_disclosure: float = 0.8, least_kind_lines: int = 10
) -> DataFrame:
    """``(tag, kind, start, end, value)`` of terms that give an entity away, on the entity's lines.

    A kind of values is an entity too. What can disclose it is the term right before a value; that takes
    ``least_kind_lines`` shared lines, since a kind stands on many. The value of such a span begins with
    ``any ``.

    A term ``t``, an entity ``e`` and both together are counted by the distinct lines of the whole corpus
    that hold them, and so are all lines, so that copies of a line count once everywhere. ``t`` discloses ``e`` when they
    share ``least_lines`` lines, ``p(e|t)`` is ``least_share`` or more, and their mutual information is
    at least ``least_disclosure`` of the information of ``e``.
    """
    # The texts are joined with what was found in them; those that cannot hold anything stay out of it.
    may = _may_hold(F.col("text"))
    long_value = may["secret"] & F.col("text").rlike(_VALUE)
    held = rows.where(may["email"] | may["ip"] | may["card"] | may["phone"] | long_value)
    held = held.join(spans.select("tag").distinct(), "tag", "left_semi").dropDuplicates(["tag"])
    lines = held.select("tag", F.posexplode(F.split("text", "\n", -1)).alias("line", "words"))
    begin = F.sum(F.length("words") + 1).over(Window.partitionBy("tag").orderBy("line")) - F.length("words") - 1
    lines = lines.withColumn("at", begin.cast("int"))
    # The line of a span is the last one that starts at or before it.
    both = lines.select("tag", "at", "line", F.lit(None).cast("string").alias("value"), F.lit(0).alias("is_span"))
    both = both.unionByName(spans.select("tag", F.col("start").alias("at"), F.lit(None).cast("int").alias("line"), F.lower("value").alias("value"), F.lit(1).alias("is_span"), "kind"), allowMissingColumns=True)
    order = Window.partitionBy("tag").orderBy("at", "is_span")
    entity = both.withColumn("line", F.last("line", ignorenulls=True).over(order)).where("is_span = 1").select("tag", "line", F.col("value").alias("entity"), F.concat(F.lit(_ANY), "kind").alias("any")).distinct()
    near = lines.join(entity.select("tag", "line").distinct(), ["tag", "line"], "left_semi")
    each = near.select("tag", "line", "at", F.xxhash64("words").alias("print"), F.posexplode(_matches("term", F.col("words"), _TERM)).alias("i", "m")).select("tag", "line", "at", "print", "i", "m.*")
    terms = _placed(each, ["tag", "line"]).select("tag", "line", "print", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end"), "value")
    # Terms inside a span are part of the entity, not signs of it.
    mark = terms.withColumn("is_span", F.lit(0)).unionByName(spans.select("tag", "start", "end", F.concat(F.lit(_ANY), "kind").alias("any"), F.lit(1).alias("is_span")), allowMissingColumns=True)
    order = Window.partitionBy("tag").orderBy("start", F.col("is_span").desc())
    before = F.max(F.when(F.col("is_span") == 1, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(F.col("is_span") == 1, F.col("start"))).over(order.rowsBetween(0, Window.unboundedFollowing))
    free = mark.withColumns({"before": before, "after": after}).where("is_span = 0 AND coalesce(before <= start, true) AND coalesce(after >= end, true)")
    free = free.select("tag", "line", "print", "start", "end", F.lower("value").alias("term"))
    free = saved(free, "terms")
    with_entity = free.join(entity.select("tag", "line", "entity").distinct(), ["tag", "line"]).select("tag", "print", "start", "end", "term", "entity")
    # What discloses a kind is the last term before a value of it, a few characters off.
    term = F.struct("print", "start", "end", F.lower("value").alias("term"))
    last = F.last(F.when(F.col("is_span") == 0, term), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    cues = mark.withColumn("last", last).where("is_span = 1").where(F.col("start") - F.col("last.end") <= _NEXT_TO)
    with_entity = with_entity.unionByName(cues.where("last.end <= start").select("tag", "last.print", F.col("last.start").alias("start"), F.col("last.end").alias("end"), "last.term", F.col("any").alias("entity")))
    with_entity = saved(with_entity, "near-terms")
    shared = with_entity.groupBy("entity", "term", "print").agg(F.lit(1).alias("one")).groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    shared = shared.where(F.col("n_both") >= F.when(F.col("entity").startswith(_ANY), least_kind_lines).otherwise(least_lines))
    shared = saved(shared, "shared-terms")
    held_by = near.select("tag", "line", F.xxhash64("words").alias("print")).join(entity, ["tag", "line"])
    held_by = held_by.select("print", F.explode(F.array("entity", "any")).alias("entity"))
    n_entity = held_by.groupBy("entity", "print").agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    # Distinct lines per term and of all, over the whole corpus; each added up before its shuffle.
    every = rows.select(F.explode(F.split("text", "\n", -1)).alias("words")).select(F.xxhash64("words").alias("print"), F.lower("words").alias("words"))
    total = every.agg(F.count_distinct("print")).first()[0]

    def disclosing(counted: DataFrame) -> DataFrame:
        information = F.log2(F.lit(max(total, 1)) / F.col("n_entity"))
        mutual = F.log2(F.col("n_both") * F.lit(max(total, 1)) / (F.col("n_entity") * F.col("n_term")))
        return counted.where((F.col("n_both") >= F.col("n_term") * least_share) & (mutual >= information * least_disclosure))

    # A term stands in no fewer lines than in those of entities: what fails by these fails by all.
    n_near = free.groupBy("term", "print").agg(F.lit(1).alias("one")).groupBy("term").agg(F.count("*").alias("n_term"))
    wanted = saved(disclosing(shared.join(n_near, "term").join(n_entity, "entity")).select("term").distinct(), "wanted-terms")
    everywhere = every.where(F.col("words").rlike(_TERM)).select("print", F.explode(F.array_distinct(F.regexp_extract_all("words", F.lit(_TERM), F.lit(0)))).alias("term"))
    n_term = everywhere.join(wanted, "term", "left_semi").groupBy("term", "print").agg(F.lit(1).alias("one")).groupBy("term").agg(F.count("*").alias("n_term"))
    judged = disclosing(shared.join(n_term, "term").join(n_entity, "entity")).select("entity", "term")
    found = with_entity.join(judged, ["entity", "term"])
    # What discloses a single entity as well is the more serious.
    only_kind = F.min(F.col("entity").startswith(_ANY)).alias("only_kind")
    found = found.groupBy("tag", "start", "end", "term").agg(only_kind)
    value = F.when(F.col("only_kind"), F.concat(F.lit(_ANY), "term")).otherwise(F.col("term"))
    return found.select("tag", F.lit("term").alias("kind"), "start", "end", value.alias("value"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> tuple[DataFrame, DataFrame]:
    """Rows ``(id, text, tag)`` and spans ``(tag, kind, start, end, value)``; ``tag`` names equal rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("tag", F.xxhash64("id", "text"))
    texts = rows.select("tag", "text")
    spans = saved(pattern_spans(texts).unionByName(secret_spans(texts)), "spans")
    return rows, spans.unionByName(saved(disclosing_terms(rows.select("tag", "text"), spans, **thresholds), "term-spans"))


def _listed(kinds: Column | None) -> Column:
    """All spans as ``kind:start:end`` by kind in the order of KINDS, then secrets and terms, then start."""
    rank = F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "secret", "term")]), F.col("kind"))
    entry = F.struct(rank.alias("r"), "start", "end", F.concat_ws(":", "kind", "start", "end").alias("s"))
    all_ = F.array_sort(F.collect_list(entry if kinds is None else F.when(kinds, entry)))
    return F.concat_ws(",", F.transform(all_, lambda x: x["s"]))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """``(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_term, n_spans)`` per row of ``docs``.

    A null text is empty and has no spans; null ids are kept; equal rows are given alike; an empty
    table gives no rows; other columns are ignored.
    """
    rows, spans = personal_data(docs, id_col, text_col, **thresholds)
    count = lambda k: F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}")
    found = spans.groupBy("tag").agg(*[count(k) for k in (*KINDS, "secret", "term")], F.count("*").alias("n_spans"), _listed(F.col("kind").isin(*KINDS)).alias("base"), _listed(None).alias("spans"))
    both = rows.select("id", "tag").join(found, "tag", "left")
    zero = lambda k: F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}")
    digest = F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256")
    return both.select("id", *[zero(k) for k in KINDS], digest, F.coalesce("spans", F.lit("")).alias("spans"), *[zero(k) for k in ("secret", "term", "spans")])


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """``docs`` in all their columns; entities become ``[KIND]``, terms that disclose only a kind ``[TERM]``, others go.

    Of overlapping spans the first to start stands for all. Null texts stay null.
    """
    _, spans = personal_data(docs, id_col, text_col, **thresholds)
    reach = F.max("end").over(Window.partitionBy("tag").orderBy("start", F.col("end").desc(), "kind").rowsBetween(Window.unboundedPreceding, -1))
    first = spans.withColumn("reach", F.coalesce(reach, F.lit(0)))
    # What lies before each span, from where the spans before it ended, then its mark.
    gone = (F.col("kind") == "term") & ~F.col("value").startswith(_ANY)
    piece = F.struct("start", "end", "reach", "kind", gone.alias("gone"))
    pieces = first.where("end > reach").groupBy("tag").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    both = docs.select("*", F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("_tag")).join(pieces.withColumnRenamed("tag", "_tag").withColumnRenamed("p", "_pieces"), "_tag", "left")
    text = docs[text_col]
    mark = lambda s: F.when(s["gone"] | (s["start"] < s["reach"]), F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    gap = lambda s: F.when(s["start"] > s["reach"], F.substring(text, s["reach"] + 1, s["start"] - s["reach"])).otherwise(F.lit(""))
    last = F.element_at("_pieces", -1)["end"]
    clean = F.concat(F.concat_ws("", F.transform("_pieces", lambda s: F.concat(gap(s), mark(s)))), F.substring(text, last + 1, F.length(text)))
    return both.select(*[F.when(F.col("_pieces").isNull(), text).otherwise(clean).alias(c) if c == text_col else docs[c] for c in docs.columns])
