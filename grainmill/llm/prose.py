"""Per-text quality statistics, and from them the texts that are no prose.

The statistics of all texts are written once; a Gaussian mixture is fitted to their standardized values by
expectation-maximization, every iteration one pass in which the tasks send their sufficient statistics (a few
kilobytes each). The components start at inspected examples and get the class of the examples they answer for; a text
is what the mixture finds most probable. One exact check follows: a text that for the most part (``MOST``) stands among
common words is running text all the same. The common words of five languages are listed; those of any other language are learned from
the texts of the corpus that carry its code.

Defined results: null, blank and sign-only texts of up to three characters have class none; repeated rows give one
result each (one in the listing); ties between components go to the first; other columns are ignored.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .examples import EXAMPLES
from .frames import lang_code, map_texts, named
from .stats import NAMES, Parsed, statistics

MOST = 0.5
#: A word is common in a language if it is at least this share of its words (so there are at most 500 of them) ...
LEAST_WORDS = 0.002
#: ... and stands in at least this share of its texts; languages of fewer texts than this have none.
LEAST_TEXTS, FEW_TEXTS = 0.1, 20
ROUNDS, SETTLED, RIDGE = 30, 1e-4, 0.02
CLASSES = ["prose", "list", "table", "junk"]
_STATS = ", ".join(f"{n} double" for n in NAMES)


def learned_words(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> np.ndarray:
    """Hashes of the common words of all languages but the listed ones. Only the texts of those languages are read."""
    if lang_col not in df.columns:
        return np.zeros(0, np.uint64)
    code = F.regexp_extract(F.lower(F.trim(F.col(f"`{lang_col}`"))), "^([a-z]+)", 1)
    rows = df.where((lang_code(F.col(f"`{lang_col}`")) == "und") & ~code.isin("", "und")).select(code.alias("lang"), F.col(f"`{text_col}`").alias("text"))

    def work(rest: dict, texts: list) -> dict:
        p, langs = Parsed(texts), rest["lang"].to_pylist()
        plain = (p.word_end - p.word_start > 1) | (p.raw[p.word_start] >= 0x80) if len(p.word_start) else np.zeros(0, bool)
        pairs, n = np.unique(np.stack([p.word_text[plain].astype(np.uint64), p.word_hash[plain]]), axis=1, return_counts=True)
        every = np.arange(p.n, dtype=np.uint64)  # a row of each text for its own count, under no word
        of = np.concatenate([pairs[0], every]).astype(np.int64)
        hashes = pa.array(np.concatenate([pairs[1], every]).view(np.int64), mask=np.r_[np.zeros(len(n), bool), np.ones(p.n, bool)])
        return {"lang": pa.array([langs[i] for i in of.tolist()], pa.string()), "h": hashes, "n": pa.array(np.concatenate([n, p.count(p.word_text[plain])]).astype(np.int64))}

    sums = materialize(map_texts(rows, work, "lang string, h bigint, n bigint").groupBy("lang", "h").agg(F.sum("n").alias("n"), F.count("*").alias("texts")), "lang-words")
    every = sums.where("h is null").select("lang", F.col("n").alias("all_words"), F.col("texts").alias("all_texts"))
    common = sums.where("h is not null").join(F.broadcast(every), "lang").where((F.col("n") >= LEAST_WORDS * F.col("all_words")) & (F.col("texts") >= LEAST_TEXTS * F.col("all_texts")) & (F.col("all_texts") >= FEW_TEXTS))
    return np.unique(common.select("h").toArrow().column("h").to_numpy().astype(np.int64).view(np.uint64))


def text_statistics(df: DataFrame, id_col: str = "rec_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The id, ``filled`` (more than three characters, or a letter or digit) and the NAMES statistics."""
    more = learned_words(df, text_col, lang_col)

    def work(rest: dict, texts: list) -> dict:
        p = Parsed(texts, more)
        made = statistics(p)
        letters = p.per_text((p.kind == 1) | (p.kind == 2))
        solid = p.per_text(p.kind != 0)
        return {"rec_id": rest["rec_id"], "filled": pa.array((letters > 0) | (solid > 3))} | {n: pa.array(made[:, i]) for i, n in enumerate(NAMES)}

    return map_texts(named(df, rec_id=id_col, text=text_col), work, f"rec_id bigint, filled boolean, {_STATS}")


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(n).to_numpy() for n in NAMES], axis=1)


class Mixture:
    """Means, covariances and weights in standardized coordinates, and the class of each component."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, means: np.ndarray) -> None:
        self.centre, self.scale = centre, scale
        self.means = means
        self.covs = np.repeat(np.eye(len(centre))[None], len(means), axis=0)
        self.weights = np.full(len(means), 1 / len(means))
        self.classes = np.zeros(len(means), np.int64)
        self.settled = False

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) / self.scale

    def shares(self, z: np.ndarray) -> tuple[np.ndarray, float]:
        """Responsibility of each component for each row, and the log-likelihood."""
        logs = np.empty((len(z), len(self.means)))
        for k, (mean, cov) in enumerate(zip(self.means, self.covs)):
            low = np.linalg.cholesky(cov)
            y = (z - mean) @ np.linalg.inv(low).T
            logs[:, k] = np.log(self.weights[k]) - 0.5 * np.einsum("ni,ni->n", y, y) - np.log(np.diag(low)).sum()
        top = logs.max(axis=1, keepdims=True)
        total = top[:, 0] + np.log(np.exp(logs - top).sum(axis=1))
        return np.exp(logs - total[:, None]), float(total.sum())

    def by_class(self, x: np.ndarray) -> np.ndarray:
        """Probability of each class for each row of plain statistics."""
        r, _ = self.shares(self.standard(x))
        return np.stack([r[:, self.classes == c].sum(axis=1) for c in range(len(CLASSES))], axis=1)


def _gather(table: DataFrame, work) -> np.ndarray:
    """``work(matrix)`` of every batch, added up by task and then over all tasks: numbers of fixed size, end to end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = work(matrix(batch))
                total = own if total is None else [a + b for a, b in zip(total, own)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pos], pa.int32()) if name == "pos" else pa.array([value.ravel().tolist()], pa.list_(pa.float64())) for pos, value in [(0, np.concatenate([np.ravel(t) for t in total]))] for name in ("pos", "sums")], ["pos", "sums"])

    rows = table.mapInArrow(run, "pos int, sums array<double>").select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    return rows.column("v").to_numpy()[np.argsort(rows.column("at").to_numpy())]


def fit(table: DataFrame) -> Mixture | None:
    """The mixture over all rows of a statistics table with ``filled``; None if there are none."""
    rows = table.where("filled").select(*NAMES)
    d = len(NAMES)
    sums = _gather(rows, lambda x: [np.array([float(len(x))]), x.sum(axis=0), (x * x).sum(axis=0)])
    if not len(sums):
        return None
    n, mean = sums[0], sums[1 : d + 1] / sums[0]
    scale = np.sqrt(np.maximum(sums[d + 1 :] / n - mean**2, 1e-6))
    seeds = statistics(Parsed([t for _, t in EXAMPLES]))
    model = Mixture(mean, scale, (seeds - mean) / scale)
    k, last = len(seeds), -np.inf
    for _ in range(ROUNDS):  # the likelihood settles or the rounds end; either way every text has been in every round
        shared = table.sparkSession.sparkContext.broadcast(model)

        def step(x: np.ndarray, shared=shared) -> list[np.ndarray]:
            z = shared.value.standard(x)
            r, log = shared.value.shares(z)
            return [np.array([log]), r.sum(axis=0), r.T @ z, np.stack([(z * r[:, k : k + 1]).T @ z for k in range(r.shape[1])])]

        got = _gather(rows, step)
        log, weight = got[0] / n, got[1 : k + 1]
        first, second = got[k + 1 : k + 1 + k * d].reshape(k, d), got[k + 1 + k * d :].reshape(k, d, d)
        some = np.maximum(weight, 1e-9)[:, None]
        means = first / some
        covs = second / some[:, :, None] - means[:, :, None] * means[:, None, :]
        alive = weight > 2 * d  # a component without texts stays where its example is
        model.means = np.where(alive[:, None], means, model.means)
        model.covs = np.where(alive[:, None, None], covs + RIDGE * np.eye(d), model.covs)
        model.weights = np.maximum(weight, 1e-6) / np.maximum(weight, 1e-6).sum()
        shared.unpersist()
        if abs(log - last) < SETTLED:
            model.settled = True
            break
        last = log
    if not model.settled:
        warnings.warn(f"the mixture still moved after {ROUNDS} rounds", stacklevel=2)
    _name(model, seeds)
    return model


def _name(model: Mixture, seeds: np.ndarray) -> None:
    """Each component gets the class of the examples it answers for, else of the nearest one."""
    z = model.standard(seeds)
    r, _ = model.shares(z)
    kinds = np.array([CLASSES.index(c) for c, _ in EXAMPLES])
    for k in range(len(model.means)):
        votes = np.bincount(kinds, weights=r[:, k], minlength=len(CLASSES))
        model.classes[k] = votes.argmax() if votes.max() > 0.3 else kinds[((z - model.means[k]) ** 2).sum(axis=1).argmin()]


def classify(df: DataFrame, id_col: str = "rec_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The statistics of every row with ``class`` and ``not_prose``, the probability of being no prose."""
    table = materialize(text_statistics(df, id_col, text_col, lang_col), "statistics")
    model = fit(table)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = batch.column("filled").to_numpy(zero_copy_only=False)
            p = shared.value.by_class(matrix(batch)) if shared.value is not None else np.zeros((batch.num_rows, len(CLASSES)))
            names = [CLASSES[c] if f else "none" for c, f in zip(p.argmax(axis=1).tolist(), filled.tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(np.where(filled, 1 - p[:, 0], 0.0))], [*batch.schema.names, "class", "not_prose"])

    return table.mapInArrow(run, f"rec_id bigint, filled boolean, {_STATS}, class string, not_prose double")


def not_prose_found(df: DataFrame, id_col: str = "rec_id", text_col: str = "text") -> DataFrame:
    """``rec_id`` of the records that are for the most part no running sentences."""
    return classify(df, id_col, text_col).where(~F.col("class").isin("prose", "none") & (F.col("prose_share") < MOST)).where("rec_id is not null").select("rec_id").distinct()
