"""Language identification by Bayesian evidence fusion.

The posterior of a language combines the likelihood of the text (hashed byte trigrams), the
declared language through its measured reliability, and a prior of the host that is smoothed
towards its address suffix, and that towards the whole corpus.  All three tables come from
grouped aggregations over every document; a document's own vote is taken out of its host's.
An undetermined class with a uniform likelihood takes texts that look like none of the languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import columns_apart, in_batches, row_keys, stored, text_bytes

LANGUAGES = ("de", "en", "es", "fr")
#: Bound of the training sample: documents of each language, those of the least row hashes.
TRAIN_ROWS = 2_000
SLOTS = 1 << 16
#: Trigrams overlap and depend on each other: the share of the text's log likelihood that counts.
TEMPER = 0.3
#: Prior weight of the undetermined class.
UNDETERMINED = 1e-3
#: Documents that a smoothed prior is worth, and that a cell of the reliability table starts with.
PRIOR_ROWS = 20.0
CELL_ROWS = 0.5
#: Documents below this posterior are rejected.
LEAST = 0.5

#: ASCII other than letters becomes a space.
LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def trigrams(data: bytes) -> np.ndarray:
    """Slots of the byte trigrams of a text in lower case, white space and signs as one space."""
    words = data.decode("utf-8", "replace").lower().encode().translate(LETTERS).split()
    if not words:
        return np.empty(0, np.uint32)
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(16)


@dataclass
class Model:
    languages: tuple[str, ...]
    log_p: np.ndarray  # of each slot, by language; the last row is the undetermined class

    def score(self, data: bytes) -> list[float] | None:
        """Log likelihoods, or None where the text has no letter."""
        slots = trigrams(data)
        return self.log_p[:, slots].sum(axis=1, dtype=np.float64).tolist() if len(slots) else None


def primary(declared: Column) -> Column:
    """Primary subtag of a declared language, e.g. ``en`` of ``en-US``."""
    return F.lower(F.regexp_extract(declared, r"^\s*([A-Za-z]+)", 1))


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
    languages: tuple[str, ...] = LANGUAGES, train_rows: int = TRAIN_ROWS,
) -> Model:
    """Trigram model fitted on at most ``train_rows`` labelled documents of each language, whole texts."""
    keyed = docs.select(*row_keys(docs, id_col).values(), primary(F.col(label_col)).alias("_label"), text_bytes(text_col).alias("_text"))
    keyed = keyed.toDF("__id", "__hash", "_label", "_text").where(F.col("_label").isin(*languages))
    order = Window.partitionBy("_label").orderBy("__hash", "__id")
    chosen = keyed.select("__id", "__hash", "_label").distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= train_rows)
    sample = keyed.join(chosen.drop("_n"), ["__id", "__hash", "_label"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(languages), SLOTS), np.int64)
        for batch in batches:
            for label, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[languages.index(label)] += np.bincount(trigrams(data), minlength=SLOTS)
        label, slot = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(slot), pa.array(seen[label, slot])], ["label", "slot", "n"])

    counted = sample.select("_label", "_text").mapInArrow(count, "label long, slot long, n long")
    counts = np.zeros((len(languages), SLOTS))
    for r in counted.groupBy("label", "slot").agg(F.sum("n")).collect():  # at most SLOTS rows a language
        counts[r[0], r[1]] = r[2]
    smooth = counts + 0.05
    log_p = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    return Model(tuple(languages), np.vstack([log_p, np.full(SLOTS, -np.log(SLOTS))]).astype(np.float32))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def scores(
    docs: DataFrame, model: Model, id_col: str, text_col: str, declared_col: str | None, host_col: str | None, url_col: str | None
) -> DataFrame:
    """(id, __id, __hash, declared, host, suffix, likelihood, best) of every row; the text stays behind."""
    none = F.lit(None).cast("string")
    declared = primary(F.col(declared_col)) if declared_col else none
    host = host_of(F.col(url_col)) if url_col else F.col(host_col).cast("string") if host_col else none
    suffix = F.regexp_extract(host, r"\.([^.]+)$", 1) if url_col else none
    blank = lambda c: F.when(c != "", c)
    string = T.StringType()
    schema = T.StructType([
        docs.schema[id_col], T.StructField("__id", T.LongType()), T.StructField("__hash", T.LongType()), T.StructField("declared", string),
        T.StructField("host", string), T.StructField("suffix", string),
        T.StructField("likelihood", T.ArrayType(T.DoubleType())), T.StructField("best", T.IntegerType()),
    ])
    prior = np.append(np.zeros(len(model.languages)), np.log(UNDETERMINED))

    def work(rows: list[tuple]) -> Iterator[tuple]:
        for *keys, data in rows:
            found = model.score(data)
            yield *keys, found, None if found is None else int(np.argmax(TEMPER * np.array(found) + prior))

    keys = row_keys(docs, id_col)
    return in_batches(
        docs, [F.col(id_col), keys["__id"], keys["__hash"], blank(declared), blank(host), blank(suffix), text_bytes(text_col)], work, schema)


def votes(n: int) -> list[Column]:
    return [F.count(F.when(F.col("best") == i, 1)).alias(f"n{i}") for i in range(n)]


def smoothed(counts: list[Column], towards: list[Column]) -> list[Column]:
    total = sum(counts, F.lit(0))
    return [(c + PRIOR_ROWS * p) / (total + PRIOR_ROWS) for c, p in zip(counts, towards, strict=True)]


def host_priors(scored: DataFrame, n: int) -> DataFrame:
    """(host, suffix, n0.., p0..): votes of each host, and the prior of its suffix smoothed by the corpus."""
    hosts = scored.groupBy("host", "suffix").agg(*votes(n))
    suffixes = hosts.groupBy("suffix").agg(*[F.sum(f"n{i}").alias(f"s{i}") for i in range(n)])
    every = hosts.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in range(n)]).first()
    corpus = [F.lit((c + 1.0) / (sum(every) + n)) for c in every]
    towards = smoothed([F.col(f"s{i}") for i in range(n)], corpus)
    shared = suffixes.select(F.col("suffix").alias("_suffix"), *[p.alias(f"p{i}") for i, p in enumerate(towards)])
    return hosts.join(shared, F.col("suffix").eqNullSafe(F.col("_suffix"))).drop("_suffix")


def reliability(scored: DataFrame, languages: tuple[str, ...]) -> dict[str, list[float]]:
    """log P(declared | language): how often texts of a language declare each one; others are one name."""
    name = F.when(F.col("declared").isin(*languages), F.col("declared")).otherwise("")
    rows = scored.where("declared is not null").groupBy(name.alias("d")).agg(*votes(len(languages))).collect()
    table = {d: np.full(len(languages), CELL_ROWS) for d in (*languages, "")}  # one row a language, and one for others
    for d, *counts in rows:
        table[d] += counts
    total = sum(table.values())
    return {d: [*np.log(v / total), float(np.log(1 / len(table)))] for d, v in table.items()}


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *, declared_col: str | None = "lang",
    host_col: str | None = "source", url_col: str | None = None, least: float = LEAST,
) -> DataFrame:
    """(id, __id, __hash, language, posterior, text_language, accepted) of every row.

    ``language`` is NULL and ``accepted`` false for a text without letters, NULL and empty ones included,
    and for one whose best class is undetermined or below ``least``.  NULL or blank declarations, hosts and
    suffixes give no evidence of their own.  Ties go to the first language.  Repeated rows vote each.
    """
    languages, n = model.languages, len(model.languages)
    scored = stored(scores(docs, model, id_col, text_col, declared_col, host_col, url_col), "scores")
    log_declared = reliability(scored, languages)
    own = F.when(F.col("host").isNotNull(), 1).otherwise(0)
    counts = [F.col(f"n{i}") - F.when(F.col("best") == i, own).otherwise(0) for i in range(n)]
    counts = [F.when(F.col("host").isNotNull(), c).otherwise(0) for c in counts]
    priors = [*smoothed(counts, [F.col(f"p{i}") for i in range(n)]), F.lit(UNDETERMINED)]
    name = F.when(F.col("declared").isin(*languages), F.col("declared")).otherwise("")
    said = [sum((F.when(name == d, float(v[i])).otherwise(0.0) for d, v in log_declared.items()), F.lit(0.0)) for i in range(n + 1)]
    logs = [
        TEMPER * F.col("likelihood")[i] + F.log(p) + F.when(F.col("declared").isNotNull(), s).otherwise(0.0)
        for i, (p, s) in enumerate(zip(priors, said, strict=True))
    ]
    joined = scored.alias("l").join(
        host_priors(scored, n).alias("r"),
        F.col("l.host").eqNullSafe(F.col("r.host")) & F.col("l.suffix").eqNullSafe(F.col("r.suffix")),
    ).select("l.*", *[f"r.{c}{i}" for c in "np" for i in range(n)])
    fused = joined.select(id_col, "__id", "__hash", "best", F.array(*logs).alias("logs")).withColumn("top", F.array_max("logs"))
    at = F.array_position("logs", F.col("top")).cast("int")
    share = 1 / F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    names = F.array(*[F.lit(x) for x in languages])
    found = fused.withColumns({"at": at, "posterior": F.when(F.col("best").isNotNull(), share)})
    accepted = F.col("best").isNotNull() & (F.col("at") <= n) & (F.col("posterior") >= least)
    return found.withColumn("accepted", accepted).select(
        id_col, "__id", "__hash", F.when(F.col("accepted"), F.get(names, F.col("at") - 1)).alias("language"), "posterior",
        F.get(names, F.col("best")).alias("text_language"), "accepted")


@columns_apart
def known_language(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options: object) -> DataFrame:
    """``docs`` without the rejected rows, ``lang_col`` set to the language found."""
    found = identify(docs, model, id_col, text_col, declared_col=lang_col, **options)
    kept = found.where("accepted").select("__id", "__hash", F.col("language").alias("_language")).dropDuplicates(["__id", "__hash"])
    return docs.withColumns(row_keys(docs, id_col)).join(kept, ["__id", "__hash"]).withColumn(lang_col, F.col("_language")).select(*docs.columns)
