"""Secret scan with linking of multipart credentials, in column expressions only.

Certain finds are reported as they are.  Weak candidates (identifiers, secrets
and endpoints that look ordinary on their own) are joined by interval: one is
reported only if the parts that complete it lie within its scope, a number of
code points to either side in the same document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelight.llm.common import text_of
from parcelight.session import cut_lineage

# The kinds that every scan reports, in their order.
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")

IDENTIFIER = (
    r"(?i)(?<![a-z0-9])(?:access_?key(?:_?id)?|client_?id|account(?:_?id)?|user(?:_?name|_?id)?)"
    r"[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{4,}"
)
SECRET = (
    r"(?i)(?<![a-z0-9])(?:private_?key|(?:secret|access)_(?:access_)?key|credentials?|pass(?:phrase)?|pwd|auth|bearer)"
    r"[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6,}"
    r"|(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
)
ENDPOINT = r"(?i)(?<![a-z0-9])(?:https?|s3|jdbc:[a-z]+|ftp|amqps?|rediss?|postgres(?:ql)?|mysql|mongodb)://[^\x00-\x20\"'<>]+"

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, kind: int, least: int = 1, group: int = 0) -> Column:
    """Matches left to right as code point intervals, without those whose group is too short."""
    regex = F.lit(pattern)
    between, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, regex, F.lit(0))
    sizes = F.transform(F.regexp_extract_all(text, regex, F.lit(group)), lambda g: F.length(g))
    none = F.array().cast(_SPAN)
    walked = F.aggregate(
        F.arrays_zip(F.slice(between, 1, F.size(hits)).alias("gap"), hits.alias("hit"), sizes.alias("size")),
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.when(
                x["size"] >= least,
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(x["gap"])).alias("start"),
                            F.lit(kind).alias("kind"),
                            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
    )
    return F.when(F.size(hits) > 0, walked["out"]).otherwise(none)


def find_parts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns with ``base`` and ``weak`` spans, each from the whole text."""
    text = F.col("__text")
    none = F.array().cast(_SPAN)
    slim = docs.select(*keep, text_of(text_col).alias("__text"))
    # a longer last group leaves no match out that the full rule keeps
    gate = ASSIGN.removesuffix("+)") + "{8,})"
    return slim.select(
        *keep,
        F.concat(
            F.when(text.rlike(gate), _spans(text, ASSIGN, 0, 8, 2)).otherwise(none),
            F.when(F.contains(text, F.lit("AKIA")), _spans(text, ACCESS, 1, 16)).otherwise(none),
            F.when(text.rlike(HEX), _spans(text, HEX, 2, 32)).otherwise(none),
        ).alias("base"),
        F.concat(
            F.when(text.rlike(IDENTIFIER), _spans(text, IDENTIFIER, 3)).otherwise(none),
            F.when(text.rlike(SECRET), _spans(text, SECRET, 4)).otherwise(none),
            F.when(F.contains(text, F.lit("://")), _spans(text, ENDPOINT, 5)).otherwise(none),
        ).alias("weak"),
    )


def _before_after(of: Column, column: str) -> dict[str, Column]:
    """Columns with the last end before and the first start after a part, among some parts of its document."""
    before = Window.partitionBy("__row").orderBy("start", "kind", "end").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("__row").orderBy(F.desc("start"), F.desc("kind"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return {
        f"__{column}_before": F.max(F.when(of, F.col("end"))).over(before),
        f"__{column}_after": F.min(F.when(of, F.col("start"))).over(after),
    }


def apart(parts: DataFrame) -> DataFrame:
    """Certain finds, and weak candidates that overlap neither them nor one another.

    A weak candidate over a certain find says nothing new.  Of weak candidates
    that overlap, the one that starts first stays, then the longer one, then the
    kind listed first: a span of text is one part of a credential.
    """
    sure = F.col("kind") < 3
    near = parts.withColumns(_before_after(sure, "sure"))
    free = F.coalesce(F.col("__sure_before") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("__sure_after") >= F.col("end"), F.lit(True))
    weak = near.where(~sure & free).groupBy("__row").agg(
        F.sort_array(F.collect_list(F.struct("start", (-F.col("end")).alias("back"), "kind"))).alias("w")
    )
    kept = F.aggregate(
        "w",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,back:int,kind:int>>").alias("out")),
        lambda acc, x: F.when(
            x["start"] >= acc["at"], F.struct((-x["back"]).alias("at"), F.concat(acc["out"], F.array(x)).alias("out"))
        ).otherwise(acc),
    )["out"]
    alone = weak.select("__row", F.explode(kept).alias("x")).select("__row", "x.start", "x.kind", (-F.col("x.back")).alias("end"))
    return parts.where(sure).select("__row", "start", "kind", "end").unionByName(alone)


def linked_parts(parts: DataFrame, scope: int = 200) -> DataFrame:
    """Rows of (__row, start, kind, end): certain finds, and weak ones whose complement is within ``scope``.

    An identifier needs a secret, a secret an identifier, an endpoint both.  A
    complement is a certain find or a weak candidate that stands apart, so it never
    overlaps what it completes.  The nearest part to either side comes from
    running extremes over the parts of one document, so no pairs are made.
    """
    near = lambda part: F.coalesce(F.col("start") - F.col(f"__{part}_before") <= scope, F.lit(False)) | F.coalesce(
        F.col(f"__{part}_after") - F.col("end") <= scope, F.lit(False)
    )
    with_near = apart(parts).withColumns(
        _before_after(F.col("kind").isin(1, 3), "id") | _before_after(F.col("kind").isin(0, 2, 4), "secret")
    )
    complete = (
        F.when(F.col("kind") == 3, near("secret"))
        .when(F.col("kind") == 4, near("id"))
        .when(F.col("kind") == 5, near("id") & near("secret"))
        .otherwise(True)
    )
    return with_near.where(complete).select("__row", "start", "kind", "end")


def scan_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), scope: int = 200, text_col: str = "text") -> DataFrame:
    """``keep`` columns with ``base`` and ``spans``, arrays of (start, kind, end) in order of start, kind, end.

    ``kind`` is a place in ``KINDS``.  One row for each input row, repeated rows
    included; a null or empty text has no spans.
    """
    names = [f"__k{i}" for i in range(len(keep))]
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text_col}`").alias("__in"))
    found = cut_lineage(find_parts(renamed, tuple(names), "__in").withColumn("__row", F.monotonically_increasing_id()))
    parts = found.select("__row", F.explode(F.concat("base", "weak")).alias("__p")).select("__row", "__p.*")
    spans = (
        linked_parts(parts, scope)
        .groupBy("__row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
        .withColumnRenamed("__row", "__found")
    )
    return found.join(spans, F.col("__row") == F.col("__found"), "left").select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)],
        F.sort_array("base").alias("base"),
        F.coalesce("spans", F.array().cast(_SPAN)).alias("spans"),
    )


def joined_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts of the certain kinds, their digest, and all spans, a row for each document.

    A null or empty text has no finds and the digest of the empty string;
    repeated rows give repeated rows.
    """
    found = scan_secrets(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by the name of its kind; overlapping spans count as one."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    walked = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    acc["out"],
                    F.when(s["start"] >= acc["at"], F.concat(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["kind"] + 1))).otherwise(F.lit("")),
                ).alias("out"),
            )
        ),
    )
    return F.when(F.size(spans) > 0, F.concat(walked["out"], F.substr(text, walked["at"] + 1, F.length(text)))).otherwise(text)
