"""Document fingerprints from chains of content words behind common words.

Common words occur in running text and hardly in lists and menus. Each of them
with a content word behind it starts a chain: the common word and the next
``CHAIN`` content words. A document's fingerprint is the set of its chains'
hashes. Near documents are found by a join of the sets, partitioned by length.
DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlwarden.llm.common import settle

CHAIN = 2
CROWD = 512  # sets of a partition that meet at one signature, in one block
SLACK = 1e-9  # so that rounding loses no pair
#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he his in is it its not of on or that the their they this to was were "
    "which will with you "
    "auf aus das dem den der des die ein eine es für im mit nicht sich sie sind und von war werden wie zu "
    "au aux avec ce dans du elle en est et il la le les ne ou par pas plus pour que qui se sur un une "
    "al como con de del el las lo los más no para por su sus y"
).split()
OPEN = "\x01"  # stands before a common word; words are letters and digits, so no text has it


def anchor_pattern(anchors: list[str]) -> str:
    """One of ``anchors`` as a whole word, with the blank behind it; by first letters, so that few are tried."""
    by_first: dict[str, list[str]] = {}
    for word in sorted(set(anchors), key=lambda w: (w[0], -len(w), w)):
        by_first.setdefault(word[0], []).append(word[1:])
    branches = (f"{first}(?:{'|'.join(rests)})" for first, rests in by_first.items())
    return f"(?<= )(?:{'|'.join(branches)}) "


def plain_words(text: Column) -> Column:
    """Lower-case words between single blanks, with a blank at either end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def signatures(text: Column, anchors: list[str] = ANCHORS, chain: int = CHAIN) -> Column:
    """Sorted distinct hashes of the chains; of a text without one, the hash of all its words. Null counts as empty."""
    words = plain_words(F.coalesce(text, F.lit("")))
    parts = F.split(F.regexp_replace(words, anchor_pattern(anchors), OPEN + "$0"), OPEN, -1)
    # Behind the first mark each part is a common word and what follows; of a run
    # of common words only the last has content words.
    parts = F.filter(F.slice(parts, F.lit(2), F.size(parts)), lambda p: F.instr(p, " ") < F.length(p))

    def behind(part: Column) -> Column:
        return F.coalesce(F.substr(part, F.instr(part, " ") + 1), F.lit(""))

    def hashes(parts: Column) -> Column:
        def one(part: Column, i: Column) -> Column:
            run = F.concat(part, *(behind(F.get(parts, i + k)) for k in range(1, chain)))
            return F.hash(F.substring_index(run, " ", chain + 1))
        return F.transform(parts, one)

    # The parts are bound once by a one-element transform; written out, every use would split the text anew.
    found = F.get(F.transform(F.array(parts), hashes), F.lit(0))
    return F.sort_array(F.array_distinct(F.when(F.size(found) > 0, found).otherwise(F.array(F.hash(words)))))


def printed(marks: Column) -> Column:
    """Eight hexadecimal digits per signature."""
    return F.array_join(F.transform(marks, lambda m: F.lpad(F.hex(m.bitwiseAND(0xFFFFFFFF)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets, which are never empty."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, signatures, fingerprint`` of every row."""
    marked = docs.select(F.col(id_col), signatures(F.col(text_col).cast("string")).alias("signatures"))
    return marked.withColumn("fingerprint", printed(F.col("signatures")))


def spans(ids: DataFrame, count: int) -> Column:
    """Number of the id's span among ``count`` or fewer of about equal rows; a null has number 0.

    The bounds are quantiles from a mergeable sketch. They are looked up in two
    steps, first among every so many of them.
    """
    shares = [k / count for k in range(1, count)]
    row = ids.agg(F.percentile_approx("id", shares, max(10_000, 10 * count))).first()
    bounds = sorted(set(row[0] or []))
    if not bounds:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    coarse = F.array(*(F.lit(b) for b in bounds[::width]))
    fine = F.array(*(F.array(*(F.lit(b) for b in bounds[k:k + width])) for k in range(0, len(bounds), width)))

    def reached(some: Column) -> Column:
        return F.size(F.filter(some, lambda b: b <= F.col("id")))

    major = reached(coarse)
    return F.when(F.col("id").isNull() | (major == 0), 0).otherwise((major - 1) * width + reached(F.get(fine, major - 1)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count: int | None = None) -> DataFrame:
    """``id, text, marks, next_text, next_marks``: each document beside the next by descending id.

    The last, null ids included, is followed by the first. Rows of equal ids are
    ordered by their texts' hashes. Texts travel once, to spans of ids; a span's
    last row takes the first of the next span, which are few.
    """
    spark = docs.sparkSession
    count = count or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("span", spans(rows.select("id"), count))
    marked = rows.withColumn("marks", signatures(F.col("text")))
    order = Window.partitionBy("span").orderBy(F.col("id").desc_nulls_last(), "tie")
    beside = marked.select("*", F.lead(F.struct("text", "marks")).over(order).alias("after"))

    # One row per span from here on; `count` bounds it.
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), (-F.col("id")).alias("back"), "tie"))
    tops = rows.groupBy("span").agg(first.alias("top"))
    down = Window.orderBy(F.col("span").desc())
    everything = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chain = tops.select("span", F.coalesce(F.lead("top").over(down), F.first("top").over(everything)).alias("follower"))
    chain = chain.select("span", (-F.col("follower.back")).alias("to_id"), F.col("follower.tie").alias("to_tie"))
    texts = rows.select("id", "tie", "text").join(
        F.broadcast(chain.withColumnRenamed("span", "from")), F.col("id").eqNullSafe(F.col("to_id")) & (F.col("tie") == F.col("to_tie")))
    heads = texts.select(F.col("from").alias("span"), F.struct("text", signatures(F.col("text")).alias("marks")).alias("head"))
    heads = heads.dropDuplicates(["span"])
    joined = beside.join(heads, "span", "left").withColumn("after", F.coalesce("after", "head"))
    return joined.select("id", "text", "marks", F.col("after.text").alias("next_text"), F.col("after.marks").alias("next_marks"))


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points, rounded down, replaced by the first as many of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(following, F.lit(1), half))


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint beside its edited text's and the next document's.

    ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``, one row per row. Null texts count as empty.
    """
    pairs = with_next(docs, id_col, text_col).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    pairs = pairs.withColumn("edited_marks", signatures(F.col("edited")))
    return pairs.select(
        F.col("id").alias(id_col), F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("marks")).alias("fingerprint"), printed(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks")).alias("near_next"))


def corpus_anchors(docs: DataFrame, count: int = 120, text_col: str = "text") -> list[str]:
    """The ``count`` words that stand in most texts, ties by word: common words of whatever languages there are."""
    words = F.array_distinct(F.split(F.trim(plain_words(F.coalesce(F.col(text_col).cast("string"), F.lit("")))), " "))
    found = docs.select(F.explode(words).alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    return [row.word for row in found.orderBy(F.desc("n"), "word").limit(count).collect()]


def near_sets(
    docs: DataFrame, least: float = 0.8, anchors: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD,
) -> tuple[DataFrame, DataFrame]:
    """``id_col, class`` of every row, and ``class_a, class_b, similarity``, once for each linked pair of classes.

    A class is all texts of one signature set, so copies are one row of the join;
    classes link if the Jaccard similarity of their sets is ``least`` or more.
    ``anchors`` are the corpus's most common words unless given.

    Sets go to partitions by length, such that linked ones are in one or in
    neighbouring partitions. Within them, sets meet at their rarest signatures: of
    any linked pair, each has a common one among its first ``n - ceil(least * n) + 1``.
    Lengths and places bound the overlap before sets are compared in full. A
    signature that more than ``crowd`` sets of a partition share is split into
    blocks, which meet pair by pair, so that no task holds all of them.

    Null and empty texts are of one class, and so are all texts without words; rows
    with equal or null ids stay apart. No rows give no rows; other columns are not
    looked at. Texts may be of any length.
    """
    if anchors is None:
        anchors = corpus_anchors(docs, text_col=text_col)
    marks = signatures(F.col(text_col).cast("string"), anchors) if anchors else F.array(F.hash(plain_words(F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    rows = docs.select(F.col(id_col).alias("id"), marks.alias("marks"))
    rows = settle(rows.withColumn("class", F.sha2(printed(F.col("marks")), 256)))
    sets = rows.groupBy("class").agg(F.first("marks").alias("marks"))
    spots = sets.select("class", F.explode("marks").alias("mark"))
    known = spots.groupBy("mark").agg(F.count("*").alias("n"))
    rarest = spots.join(known, "mark").groupBy("class").agg(F.sort_array(F.collect_list(F.struct("n", "mark"))).alias("marks"))
    size = F.size("marks")
    rarest = rarest.select("class", size.alias("size"), F.posexplode(F.slice("marks", F.lit(1), size - F.ceil(least * size - SLACK).cast("int") + 1)))
    # A signature of one set alone is met by none.
    rarest = rarest.where("col.n > 1").select("class", "size", F.col("pos").alias("at"), F.col("col.mark").alias("mark"))
    length = F.floor(F.log("size") / float(-math.log(least)) + SLACK)
    rarest = settle(rarest.withColumn("cell", length))

    places = rarest.select("mark", F.explode(F.array("cell", F.col("cell") + 1)).alias("cell")).groupBy("mark", "cell").agg(F.count("*").alias("sets"))
    blocks = places.where(F.col("sets") > crowd).select("mark", "cell", F.ceil(F.col("sets") / crowd).cast("int").alias("blocks"))

    def dealt(some: DataFrame, mine: str, other: str) -> DataFrame:
        """Each row in its own block, once for every block of the other side."""
        some = some.join(blocks, ["mark", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        return some.withColumn(mine, F.pmod(F.xxhash64("class"), F.col("blocks"))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks").cast("bigint") - 1))).drop("blocks")

    shorter = rarest.select("mark", "class", "size", "at", F.explode(F.array("cell", F.col("cell") + 1)).alias("cell"))
    a, b = dealt(shorter, "left", "right").alias("a"), dealt(rarest, "right", "left").alias("b")
    both = (F.col("a.size") + F.col("b.size")) * (least / (1 + least)) - SLACK  # of a linked pair's signatures are common
    rest = F.least(F.col("a.size") - F.col("a.at"), F.col("b.size") - F.col("b.at"))
    met = a.join(b, ["mark", "cell", "left", "right"]).where(
        (F.struct("a.size", "a.class") < F.struct("b.size", "b.class")) & (F.col("a.size") >= least * F.col("b.size") - SLACK) & (rest >= both))
    met = met.select(F.col("a.class").alias("class_a"), F.col("b.class").alias("class_b")).distinct()
    one, two = (sets.select(F.col("class").alias(f"class_{side}"), F.col("marks").alias(f"marks_{side}")) for side in "ab")
    links = met.join(one, "class_a").join(two, "class_b").select("class_a", "class_b", likeness(F.col("marks_a"), F.col("marks_b")).alias("similarity"))
    return rows.select(F.col("id").alias(id_col), "class"), links.where(F.col("similarity") >= least)
