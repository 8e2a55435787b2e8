"""Document fingerprints: a Merkle tree over sections, paragraphs and runs of words, in column expressions only.

Paragraphs are lines; a section ends after a paragraph whose digest says so, and
a leaf, a run of words within a paragraph, after a word whose hash says so, so
that an insertion moves no border but those beside it.  The root is the digest of
the section digests, each of the digests of its paragraphs, hence equal texts and
only they share a root.  Two trees are compared by descent: of sections and then
of paragraphs only those that differ are opened, and the leaves that neither side
finds in the other's open branches tell how unlike the texts are.  The sections
and paragraphs in which they differ say where an edit is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelight.llm.common import text_of

LEAF_WORDS = 4  # of so many words one ends a leaf
_TOKEN = r"\n|[^\x20\x09-\x0D]+"
_DIGEST = 64  # characters


def paragraphs(text: Column) -> Column:
    """Digest of each line."""
    return F.transform(F.split(text, "\n", -1), lambda p: F.sha2(p, 256))


def sections(digests: Column) -> Column:
    """Digest of each section; one paragraph in sixteen ends a section."""
    marked = F.transform(digests, lambda d: F.concat(d, F.when(F.endswith(d, F.lit("0")), F.lit(";")).otherwise(F.lit(","))))
    return F.transform(F.filter(F.split(F.array_join(marked, ""), ";", -1), lambda s: s != ""), lambda s: F.sha2(s, 256))


def root(section_digests: Column) -> Column:
    return F.sha2(F.array_join(section_digests, ","), 256)


def leaves(text: Column) -> Column:
    """Distinct hashes of the runs of words in each paragraph; a line in which no word ends a leaf is one leaf."""

    def marked(token: Column) -> Column:
        ends = F.pmod(F.xxhash64(token), F.lit(LEAF_WORDS)) == 0
        return F.when(token == "\n", token).otherwise(F.concat(token, F.when(ends, F.lit("\n")).otherwise(F.lit(" "))))

    runs = F.split(F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), marked), ""), "\n", -1)
    hashes = F.array_distinct(F.transform(runs, lambda r: F.xxhash64(F.rtrim(r))))
    return F.array_remove(hashes, F.xxhash64(F.lit("")))  # what stands before, between and after line breaks


def branches(text: Column) -> Column:
    """The sections of a text, each its paragraphs line by line behind their digests.

    No paragraph holds a line break and a digest never starts with ``;``, so the borders are plain.
    """

    def marked(paragraph: Column) -> Column:
        digest = F.sha2(paragraph, 256)
        return F.concat(digest, paragraph, F.when(F.endswith(digest, F.lit("0")), F.lit("\n;")).otherwise(F.lit("\n")))

    held = F.split(F.array_join(F.transform(F.split(text, "\n", -1), marked), ""), "\n;", -1)
    return F.filter(F.transform(held, lambda s: F.regexp_replace(s, "\n$", "")), lambda s: s != "")


def open_paragraphs(left: Column, right: Column) -> Column:
    """Paragraphs, with digests, in those sections of ``left`` that ``right`` does not have."""
    return F.flatten(F.transform(F.array_except(left, right), lambda s: F.split(s, "\n", -1)))


def _texts(marked: Column) -> Column:
    return F.array_join(F.transform(marked, lambda p: F.substr(p, F.lit(_DIGEST + 1))), "\n")


def with_likeness(trees: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """``trees`` with a likeness for each pair of prefixes of the columns ``_branches``, ``_leaves`` and ``_lines``.

    ``_lines`` counts the distinct paragraphs; where all of them differ the leaves are those of the whole text.

    1 less the share of leaves, of those of both texts, that lie in differing paragraphs of differing sections and
    that the differing paragraphs of the other text do not hold.  1 for two texts without words and for equal ones.
    """
    sides = {f"{name}{side}": (p, q) for name, (a, b) in pairs.items() for side, p, q in (("__a", a, b), ("__b", b, a))}
    opened = trees.select(
        "*", *[open_paragraphs(F.col(f"{p}_branches"), F.col(f"{q}_branches")).alias(f"{n}_open") for n, (p, q) in sides.items()]
    )
    other = {n: n[:-1] + ("b" if n.endswith("a") else "a") for n in sides}
    apart = opened.select(
        "*", *[F.array_except(F.col(f"{n}_open"), F.col(f"{other[n]}_open")).alias(f"{n}_apart") for n in sides]
    )
    differing = apart.select(
        "*",
        *[
            F.when(F.size(f"{n}_apart") == F.col(f"{p}_lines"), F.col(f"{p}_leaves"))
            .when(F.size(f"{n}_apart") == 0, F.array().cast("array<bigint>"))
            .otherwise(leaves(_texts(F.col(f"{n}_apart"))))
            .alias(f"{n}_left")
            for n, (p, _) in sides.items()
        ],
    )
    out = []
    for name, (a, b) in pairs.items():
        total = F.size(f"{a}_leaves") + F.size(f"{b}_leaves")
        unmatched = sum(F.size(F.array_except(F.col(f"{n}_left"), F.col(f"{other[n]}_left"))) for n in (f"{name}__a", f"{name}__b"))
        out.append(F.when(total == 0, 1.0).otherwise(1.0 - unmatched / total).alias(name))
    return differing.select(*trees.columns, *out)


def merkle_trees(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (root) and the tree: section digests, paragraph digests, leaf hashes.

    A row for each input row; a null text is empty and has one empty paragraph.
    """
    return (
        docs.select("doc_id", text_of(text_col).alias("__text"))
        .select("doc_id", "__text", paragraphs(F.col("__text")).alias("paragraphs"))
        .select("doc_id", sections(F.col("paragraphs")).alias("sections"), "paragraphs", leaves(F.col("__text")).alias("leaves"))
        .select("doc_id", root(F.col("sections")).alias("fingerprint"), "sections", "paragraphs", "leaves")
    )


def edited_places(left: Column, right: Column) -> Column:
    """Zero-based places in ``left`` (sections or paragraphs) that ``right`` does not have."""
    held = F.array_except(left, right)
    return F.filter(F.transform(left, lambda d, i: F.when(F.array_contains(held, d), i)), lambda i: i.isNotNull())


def with_next(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """doc_id, __text, __next: each text with the text of the next document by id; the last has the first.

    Ids are cut into ranges at quantiles; each range is ordered in a task of its
    own, and the last row of a range gets the first row of the next filled one:
    as many carried rows as there are ranges.  A null id comes first.  Rows that
    repeat an id follow each other in the order of their texts, and one row alone
    is its own next.
    """
    spark = docs.sparkSession
    n = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit((i + 1) / n) for i in range(n - 1)]) if n > 1 else F.array(F.lit(0.5))
    slim = docs.select("doc_id", F.col("doc_id").cast("bigint").alias("__id"), text_of().alias("__text"))
    # at most ``n`` numbers
    borders = sorted(set(slim.select(F.percentile_approx("__id", shares, 10_000)).first()[0] or []))
    block = F.lit(0)
    if borders:
        marks = F.array(*[F.lit(b).cast("bigint") for b in borders])
        block = F.coalesce(F.size(F.filter(marks, lambda b: b < F.col("__id"))), F.lit(0))
    order = ["__id", "__text"]
    ranged = slim.withColumn("__block", block)
    inside = Window.partitionBy("__block").orderBy(*order)
    rows = ranged.select("*", F.lead("__text").over(inside).alias("__follows"))
    # the smallest id of each filled range, at most ``n`` numbers, null among them
    smallest = slim.select("__id").withColumn("__block", block).groupBy("__block").agg(
        F.min("__id").alias("__least"), F.max(F.col("__id").isNull()).alias("__null")
    )
    least = [None if r["__null"] else r["__least"] for r in smallest.collect()]
    known = [i for i in least if i is not None]
    wanted = F.col("__id").isin(known) if known else F.lit(False)
    if None in least:
        wanted = wanted | F.col("__id").isNull()
    firsts = slim.where(wanted).withColumn("__block", block).groupBy("__block").agg(F.min("__text").alias("__first"))
    # one row a block; its order needs no more than the numbers of the blocks
    over = Window.orderBy("__block")
    carried = firsts.select(
        F.col("__block").alias("__of"),
        F.coalesce(F.lead("__first").over(over), F.first("__first").over(over)).alias("__carried"),
    )
    return rows.join(carried, F.col("__block") == F.col("__of")).select(
        "doc_id", "__text", F.coalesce("__follows", "__carried").alias("__next")
    )


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they and the next document are.

    A row for each input row; a null text is empty.  The next document is that of ``with_next``, which says what
    null and repeated ids give.
    """
    text, following = F.col("__text"), F.col("__next")
    quarter = F.floor(F.length(text) / 4).cast("int")
    edited = with_next(docs).select(
        "doc_id",
        "__text",
        "__next",
        F.concat(F.left(text, F.length(text) - quarter), F.left(following, quarter)).alias("__edited"),
    )
    digests = edited.select(
        "doc_id",
        F.length("__text").cast("bigint").alias("n_chars"),
        F.sha2("__edited", 256).alias("edited_sha256"),
        root(sections(paragraphs(text))).alias("fingerprint"),
        root(sections(paragraphs(F.col("__edited")))).alias("edited_fingerprint"),
        branches(text).alias("own_branches"),
        branches(F.col("__edited")).alias("edited_branches"),
        branches(following).alias("next_branches"),
        *[
            column.alias(f"{name}_{what}")
            for name, held in (("own", text), ("edited", F.col("__edited")), ("next", following))
            for what, column in (("leaves", leaves(held)), ("lines", F.size(F.array_distinct(F.split(held, "\n", -1)))))
        ],
    )
    told = with_likeness(digests, {"near_edited": ("own", "edited"), "near_next": ("own", "next")})
    return told.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
