"""Language identification by a byte convolutional network, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedcheck.llm.common import record_batches, small_batches

#: Bytes of a window, and the network's sizes: byte embedding, filter widths, filters of each width.
WINDOW, EMBED, WIDTHS, FILTERS = 256, 8, (2, 3, 4, 5), 16
#: Bounds of the training sample: documents of a language, and windows of a document.
SAMPLE_DOCS, SAMPLE_WINDOWS = 500, 4
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")


def windows_of(text: str) -> np.ndarray:
    """The whole text in UTF-8 as rows of WINDOW bytes, the last one filled up with zeros."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    rows = np.zeros((max(1, -(-len(data) // WINDOW)), WINDOW), np.uint8)
    rows.reshape(-1)[: len(data)] = data
    return rows


@dataclass
class Network:
    """Embedded bytes, filters of several widths, maximum over the window, softmax."""

    langs: list[str]
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # (widest * EMBED) x all filters; a narrow filter has zeros after its width
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def new(cls, langs: list[str], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        widest, n = max(WIDTHS), FILTERS * len(WIDTHS)
        filters = rng.normal(0, 0.25, (widest * EMBED, n)).astype(np.float32) * cls.mask()
        return cls(langs, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), filters, np.zeros(n, np.float32), rng.normal(0, 0.1, (n, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))

    @staticmethod
    def mask() -> np.ndarray:
        rows = np.arange(max(WIDTHS) * EMBED)[:, None] // EMBED
        return (rows < np.repeat(WIDTHS, FILTERS)[None, :]).astype(np.float32)

    def _columns(self, x: np.ndarray) -> np.ndarray:
        """For each position of each row, the embedded bytes that the widest filter sees."""
        widest = max(WIDTHS)
        e = self.embed[np.pad(x, ((0, 0), (0, widest - 1)))].reshape(len(x), -1)
        view = np.lib.stride_tricks.as_strided(e, (len(x), x.shape[1], widest * EMBED), (e.strides[0], e.strides[1] * EMBED, e.strides[1]))
        return np.ascontiguousarray(view).reshape(-1, widest * EMBED)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for each window."""
        found = []
        for i in range(0, len(x), 32):
            block = x[i : i + 32]
            h = (self._columns(block) @ self.filters).reshape(len(block), WINDOW, -1).max(axis=1)
            found.append(np.maximum(h + self.bias, 0))
        z = np.concatenate(found) @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def train(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 6, rate: float = 3e-3, batch: int = 32, seed: int = 11) -> None:
        """Stochastic gradient descent on cross-entropy, with Adam's step sizes."""
        rng, mask = np.random.default_rng(seed), self.mask()
        names = ("embed", "filters", "bias", "out", "out_bias")
        moment = {n: (np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))) for n in names}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(order), batch):
                pick = order[i : i + batch]
                rows, n = x[pick], len(pick)
                columns = self._columns(rows)
                responses = (columns @ self.filters).reshape(n, WINDOW, -1)
                at = responses.argmax(axis=1)
                h = np.take_along_axis(responses, at[:, None, :], 1)[:, 0, :] + self.bias
                a = np.maximum(h, 0)
                z = a @ self.out + self.out_bias
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(n), y[pick]] -= 1
                dz = p * weight[pick][:, None] / n
                da = (dz @ self.out.T) * (h > 0)
                # Only the position of the maximum of each filter gets a gradient.
                seen = columns[(np.arange(n)[:, None] * WINDOW + at).reshape(-1)].reshape(n, -1, max(WIDTHS) * EMBED)
                grads = {"out": a.T @ dz, "out_bias": dz.sum(0), "bias": da.sum(0), "filters": np.einsum("nfk,nf->kf", seen, da) * mask}
                back = (da[:, :, None] * self.filters.T[None]).reshape(-1, EMBED)
                where = (at[:, :, None] + np.arange(max(WIDTHS))).reshape(n, -1)
                bytes_seen = np.take_along_axis(np.pad(rows, ((0, 0), (0, max(WIDTHS) - 1))), where, 1).reshape(-1)
                grads["embed"] = np.zeros_like(self.embed)
                np.add.at(grads["embed"], bytes_seen, back)
                step += 1
                now = rate * (0.3 if epoch >= epochs - 2 else 1)
                for k in names:
                    m, v = moment[k]
                    m += 0.1 * (grads[k] - m)
                    v += 0.001 * (grads[k] ** 2 - v)
                    w = getattr(self, k)
                    w -= (now * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        """Language and score of each whole text: the mean over its windows, weighted by their bytes."""
        rows, owner, size = [], [], []
        for i, text in enumerate(texts):
            if text and _LETTER.search(text):
                w = windows_of(text)
                rows.append(w)
                owner.append(np.full(len(w), i))
                size.append((w != 0).sum(axis=1))
        total = np.zeros((len(texts), len(self.langs)))
        mass = np.zeros(len(texts))
        if rows and self.langs:
            owner, size = np.concatenate(owner), np.concatenate(size).astype(float)
            np.add.at(total, owner, self.scores(np.concatenate(rows)) * size[:, None])
            np.add.at(mass, owner, size)
        for i in range(len(texts)):
            if mass[i] == 0:
                yield UNKNOWN, 0.0
            else:
                best = int(total[i].argmax())
                yield self.langs[best], float(min(1.0, total[i, best] / mass[i]))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Network:
    """Train on a bounded sample of ``docs`` (``doc_id``, ``text``, ``lang``) that are not held out: about
    ``sample_docs`` documents of each language, chosen by a hash of their ids, and up to four
    windows spread over each whole text. Documents without letters or label teach nothing;
    without any labelled document the network knows no language. Where ids are repeated, twice as
    many documents of a language at most.
    """
    labelled = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return Network.new([])
    place = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20))
    share = F.create_map(*[F.lit(v) for k in langs for v in (k, min(1 << 20, -(-(sample_docs << 20) // counts[k])))])
    chosen = labelled.filter(place < share[F.col("lang")])
    n = F.octet_length("text")
    starts = [F.greatest(F.lit(0), ((n - WINDOW) * i / F.lit(max(1, SAMPLE_WINDOWS - 1))).cast("int")) for i in range(SAMPLE_WINDOWS)]
    cut = F.array(*[F.substring(F.col("text").cast("binary"), s + 1, F.lit(WINDOW)) for s in starts])
    rows = chosen.select("lang", F.when(n <= WINDOW, F.slice(cut, 1, 1)).otherwise(cut).alias("cut"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("cut"))
    rows = rows.withColumn("nth", nth).filter(F.col("nth") <= 2 * sample_docs).orderBy("lang", "cut").collect()
    place_of = {k: i for i, k in enumerate(langs)}
    x, y = [], []
    for r in rows:
        for piece in r.cut:
            row = np.zeros(WINDOW, np.uint8)
            row[: len(piece)] = np.frombuffer(bytes(piece), np.uint8)
            x.append(row)
            y.append(place_of[r.lang])
    x, y = np.array(x), np.array(y)
    often = np.bincount(y, minlength=len(langs))
    net = Network.new(langs)
    net.train(x, y, (len(y) / (len(langs) * np.maximum(often, 1)))[y].astype(np.float32))
    return net


_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): doc_id, held_out, lang_pred, score (0 to 1).

    Each whole text is read as windows of 256 bytes, which the network judges in batches;
    nothing is shuffled, and the network (a few thousand numbers) travels with the task.
    A null text or one without a letter is ``und`` with score 0. Repeated rows, null ids
    and other columns do no harm; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)

    def rows(batches):
        for batch in batches:
            ids, texts, held = (c.to_pylist() for c in batch.columns)
            for i in range(0, len(ids), 64):
                for d, h, (lang, score) in zip(ids[i : i + 64], held[i : i + 64], net.predict(texts[i : i + 64])):
                    yield d, h, lang, score

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    return read.mapInArrow(lambda b: record_batches(rows(b), _OUT), "doc_id long, held_out boolean, lang_pred string, score double")
