"""Document fingerprints from closed syncmers, by column functions only.

Symbols are words (single characters in scripts without spaces).  A k-mer of words is selected if the
least of its inner s-mers is the first or the last one, which depends on its own words alone: the same run of words is
selected wherever it stands.  The fingerprint is a bottom sketch of the selected k-mers; the likeness of two
sketches estimates the Jaccard index, and is exact while both hold all their k-mers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import row_keys, stored

#: Words of a k-mer and of an inner s-mer: five s-mers in a k-mer, two fifths of all k-mers are selected.
K, S = 6, 2
#: Values of a sketch.
SKETCH = 64

#: A character of a script without spaces, or up to 24 others between white space.
UNSPACED = r"\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
SYMBOL = rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]{{1,24}}"


def upto(n: Column) -> Column:
    """0, 1 .. n - 1, or no element where n is not over 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def with_anchors(df: DataFrame, text: Column, name: str) -> DataFrame:
    """``df`` with ``name``: an array of (word, hash) of the selected k-mers of ``text``, words counted from 0.

    A text whose words are too few for a selected k-mer has one anchor of all of them; one without words has none.
    Each step is a column of its own, so that it is computed once a row and not once an element.
    """
    words, inner = f"_{name}_words", f"_{name}_inner"
    df = df.withColumn(words, F.transform(F.regexp_extract_all(text, F.lit(SYMBOL), F.lit(0)), lambda w: F.hash(w)))
    w, g = F.col(words), F.col(inner)
    df = df.withColumn(inner, F.transform(upto(F.size(w) - (S - 1)), lambda i: F.hash(w[i], w[i + 1])))
    edge = K - S

    def pick(i: Column) -> Column:
        closed = F.least(g[i], g[i + edge]) <= F.least(*[g[i + j] for j in range(1, edge)])
        return F.when(closed, F.struct(i.alias("word"), F.hash(g[i], g[i + 2], g[i + 4]).alias("hash")))

    df = df.withColumn(name, F.filter(F.transform(upto(F.size(g) - edge), pick), lambda a: a.isNotNull()))
    whole = F.array(F.struct(F.lit(0).alias("word"), F.hash(w).alias("hash")))
    return df.withColumn(name, F.when((F.size(name) == 0) & (F.size(w) > 0), whole).otherwise(F.col(name))).drop(words, inner)


def sketch(anchors: str) -> Column:
    """The least distinct hashes of an array of anchors, in order."""
    return F.slice(F.sort_array(F.array_distinct(F.col(anchors)["hash"])), 1, SKETCH)


def shown(of: Column) -> Column:
    """A sketch as a string, eight hexadecimal digits a value."""
    return F.array_join(F.transform(of, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Share of the least values of both sketches together that both hold; 1 for two texts without words."""
    both = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.size(both))


def anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, anchors, fingerprint) of every row; a NULL text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return with_anchors(docs.select(id_col, text.alias("_text")), F.col("_text"), "anchors").select(
        id_col, "anchors", shown(sketch("anchors")).alias("fingerprint"))


def predecessors(rows: DataFrame) -> DataFrame:
    """Distinct (__id, __hash) of ``rows`` (__none, __id, __hash, n_chars) with the row before it in descending order.

    The order is by id (NULL last), then hash, and closes to a ring.  It is dealt out by range; only the last row of each
    partition meets the others.
    """
    descending = [F.col("__none"), F.col("__id").desc(), F.col("__hash")]
    ranged = rows.dropDuplicates(["__none", "__id", "__hash"]).repartitionByRange(*descending).withColumn("_part", F.spark_partition_id())
    ranged = stored(ranged, "ordered")
    this = F.struct("__id", "__hash", "n_chars")
    key = F.struct("__none", F.bitwise_not("__id"), "__hash")
    lasts = ranged.groupBy("_part").agg(F.max_by(this, key).alias("_last"))
    by_part = Window.orderBy("_part")  # a row for each partition
    ring = F.coalesce(F.lag("_last").over(by_part), F.last("_last").over(by_part.rowsBetween(0, Window.unboundedFollowing)))
    before = lasts.select("_part", ring.alias("_before"))
    inside = F.lag(this).over(Window.partitionBy("_part").orderBy(*descending))
    linked = ranged.withColumn("_inside", inside).join(before, "_part").withColumn("prev", F.coalesce("_inside", "_before"))
    return stored(linked.select("__id", "__hash", F.col("prev.__id").alias("prev_id"), F.col("prev.__hash").alias("prev_hash"),
                                F.col("prev.n_chars").alias("prev_chars")), "links")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited, sketch, next_sketch, edited_sketch) of every row.

    ``edited`` is the text with its last third replaced by as many first characters of the next document in
    descending order of ids.  A NULL text is empty, a NULL id the last; rows equal in every column take one place in the
    order, and each gives a row.  An empty table gives none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = row_keys(docs, id_col)
    rows = docs.select(F.col(id_col), text.alias("_text"), F.col(id_col).isNull().alias("__none"),
                       keys["__id"].alias("__id"), keys["__hash"].alias("__hash")).withColumn("n_chars", F.length("_text"))
    links = predecessors(rows.select("__none", "__id", "__hash", "n_chars"))
    own = with_anchors(rows.drop("__none"), F.col("_text"), "_anchors").withColumn("sketch", sketch("_anchors")).drop("_anchors")
    placed = own.join(links, ["__id", "__hash"])
    # ordered by all that ``changed`` reads, so that both ask for the same columns and share the shuffle of the texts
    first = Window.partitionBy("__id", "__hash").orderBy("prev_id", id_col, "n_chars")
    once = placed.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    heads = once.select(
        F.col("prev_id").alias("__id"), F.col("prev_hash").alias("__hash"), F.col("sketch").alias("next_sketch"),
        F.substring(F.col("_text"), F.lit(1), F.floor(F.col("prev_chars") / 3).cast("int")).alias("_head"))
    kept = F.substring(F.col("_text"), F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 3)).cast("int"))
    changed = placed.join(heads, ["__id", "__hash"]).withColumn("edited", F.concat(kept, "_head"))
    return with_anchors(changed, F.col("edited"), "_anchors").withColumn("edited_sketch", sketch("_anchors")).select(
        id_col, F.col("n_chars").cast("long").alias("n_chars"), "edited", "sketch", "next_sketch", "edited_sketch")
