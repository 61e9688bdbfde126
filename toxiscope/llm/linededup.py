"""Line deduplication: suffix ranks over line-ID sequences by distributed prefix doubling.

A document is the sequence of its lines that hold a word. Ranks start as the sorted
position of the line IDs; a round turns the ranks of prefixes of h lines into those of 2h
lines by sorting the distinct pairs (rank at i, rank at i + h). All suffixes that share a
rank share that prefix: they are one interval of the suffix array whose longest common
prefixes are at least h. Suffixes alone in their interval cannot begin a longer repeat and
leave, so rounds shrink to what repeats.

Maximal repeated runs count from ``min_words`` words, so that chance repeats of a word or
two are left alone. Such a run is the union of its least windows (from each line the
fewest lines forward, and to each line the fewest lines back, that hold ``min_words``
words), and a window of h lines is named by the ranks of its first and its last 2^k lines,
2^k <= h < 2^(k+1). No window has more than ``min_words`` lines, which bounds the rounds:
deeper intervals could not change a deletion. In each interval of equal windows the first
one in the order of documents stays and the lines of the later ones are deleted.

Order: document id, null last; rows with one id in the order of the stored table; position.

Defined results: a null text stays null; lines without a word are kept and join no run; an
empty text stays; a text of any length is split whole; repeated rows are later copies; an
empty table gives an empty result. Extra columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toxiscope.llm.common import count_words, drop_stored, free_name, spread_rows, stored
from toxiscope.operators.ranking import global_index

#: Production parameter: the fewest words of a repeated run.
MIN_WORDS = 5
NEWLINE = "\n"


def line_rows(docs: DataFrame, row: str, key: str, text: str, min_words: int) -> DataFrame:
    """``(row, id, pos, line_no, line, ahead, back)``: lines that hold a word.

    ``ahead`` (``back``) is the number of lines of the least window that begins (ends) here,
    0 when the document has too few words on that side.
    """
    lines = F.filter(
        F.transform(
            F.split(F.col(text), NEWLINE, -1),
            lambda x, i: F.struct(i.alias("line_no"), F.md5(x.cast("binary")).alias("line"), count_words(x).cast("int").alias("words")),
        ),
        lambda x: x["words"] > 0,
    )

    def least(words: Column) -> Column:
        """Index of the first prefix sum that reaches min_words, from 1; 0 if none does."""
        step = F.aggregate(
            words,
            F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n")),
            lambda a, x: F.struct(
                (a["sum"] + x).alias("sum"), (a["n"] + F.when(a["sum"] < min_words, 1).otherwise(0)).alias("n")
            ),
        )
        return F.when(step["sum"] >= min_words, step["n"]).otherwise(0)

    rows = docs.where(F.col(text).isNotNull()).select(
        F.col(row).alias("row"), F.col(key).alias("id"), lines.alias("lines")
    ).withColumn("words", F.transform("lines", lambda x: F.least(x["words"], F.lit(min_words))))
    n = F.size("lines")
    span = lambda begin, size: F.slice("words", begin, size)
    each = F.transform(
        "lines",
        lambda x, i: F.struct(
            i.alias("pos"), x["line_no"].alias("line_no"), x["line"].alias("line"),
            least(span(i + 1, F.least(F.lit(min_words), n - i))).alias("ahead"),
            least(F.reverse(span(F.greatest(i + 2 - min_words, F.lit(1)), F.least(i + 1, F.lit(min_words))))).alias("back"),
        ),
    )
    return rows.select("row", "id", F.explode(each).alias("l")).select("row", "id", "l.*")


def first_ranks(lines: DataFrame) -> DataFrame:
    """``(row, pos, rank)`` of the lines that occur more than once."""
    ids = lines.groupBy("line").count().where("count > 1").select("line")
    return lines.join(global_index(ids, [F.col("line")], "rank"), "line").select("row", "pos", "rank")


def double_ranks(ranks: DataFrame, h: int) -> DataFrame:
    """Ranks of prefixes of 2h lines from those of h lines; only those that repeat."""
    later = ranks.select("row", (F.col("pos") - h).alias("pos"), F.col("rank").alias("second"))
    pairs = stored(ranks.join(later, ["row", "pos"]), "line-pairs")
    order = global_index(
        pairs.groupBy("rank", "second").count().where("count > 1").select("rank", "second"),
        [F.col("rank"), F.col("second")], "new",
    )
    return pairs.join(order, ["rank", "second"]).select("row", "pos", F.col("new").alias("rank"))


def later_copies(lines: DataFrame, min_words: int) -> DataFrame:
    """``(row, line_no)`` of every line to delete; ``lines`` is a stored table."""
    asked = lines.where("ahead > 0").select("row", "id", "pos", F.col("ahead").alias("h")).unionByName(
        lines.where("back > 0").select("row", "id", (F.col("pos") - F.col("back") + 1).alias("pos"), F.col("back").alias("h"))
    ).distinct()
    ranks, k, windows = stored(first_ranks(lines), "line-ranks"), 0, None
    while True:
        size = 1 << k
        here = asked.where(F.col("h").between(size, min(2 * size - 1, min_words)))
        tail = ranks.select("row", F.col("pos").alias("at"), F.col("rank").alias("last"))
        named = (
            here.join(ranks.withColumnRenamed("rank", "head"), ["row", "pos"])
            .withColumn("at", F.col("pos") + F.col("h") - size)
            .join(tail, ["row", "at"]).drop("at")
        )
        windows = named if windows is None else windows.unionByName(named)
        if 2 * size > min_words:
            break
        ranks = stored(double_ranks(ranks, size), "line-ranks")
        k += 1
    windows = stored(windows, "line-windows")
    place = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row"), F.col("pos"))
    first = windows.groupBy("h", "head", "last").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    # stored, so that the join shuffles both sides and can split the windows of a hot line
    first = stored(first.where("n > 1"), "line-first")
    copies = (
        windows.join(first, ["h", "head", "last"])
        .where((F.col("row") != F.col("first.row")) | (F.col("pos") != F.col("first.pos")))
        .select("row", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("h") - 1)).alias("pos"))
        .distinct()
    )
    return copies.join(lines.select("row", "pos", "line_no"), ["row", "pos"]).select("row", "line_no")


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, drop_emptied: bool = False,
    removed: str | None = None,
) -> DataFrame:
    """``docs`` with the later copies of repeated line runs deleted from ``text``.

    ``removed`` names an added array<int> column with the deleted line numbers (from 0).
    ``drop_emptied`` leaves out the documents that lost their last line with a word.
    """
    row, gone = free_name(docs, "_line_row"), removed or free_name(docs, "_line_gone")
    columns = docs.columns
    docs = stored(spread_rows(docs).withColumn(row, F.monotonically_increasing_id()), "line-documents")
    lines = stored(line_rows(docs, row, key, text, min_words), "line-rows")
    gone_rows = later_copies(lines, min_words).groupBy(F.col("row").alias(row)).agg(
        F.sort_array(F.collect_list("line_no")).alias(gone)
    )
    # the deletions grow with the documents: a shuffle join at every size
    out = docs.join(stored(gone_rows, "line-gone").hint("merge"), row, "left")
    drop_stored(lines)
    all_lines = F.split(F.col(text), NEWLINE, -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(gone))
    kept = F.array_join(F.transform(left, lambda i: F.get(all_lines, i)), NEWLINE)
    new = F.when(F.col(gone).isNull(), F.col(text)).otherwise(kept)
    if drop_emptied:
        out = out.where(F.col(gone).isNull() | (count_words(new) > 0))
    out = out.withColumn(text, new).drop(row)
    if removed:
        return out.withColumn(removed, F.coalesce(F.col(removed), F.array().cast("array<int>")))
    return out.select(*columns)
