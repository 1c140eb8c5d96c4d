"""Languages of texts, from a convolutional network over their bytes.

Bytes are embedded, filters of several widths slide over them, each filter keeps
its largest answer in a window, and a softmax over those answers gives the
languages' shares. The network is trained with numpy on windows of a bounded,
hash-chosen sample of labelled texts. A text is read whole, in windows of fixed
length; its shares are the mean of its windows', weighted by their bytes.

Defined results: a null text and one without a letter are ``und`` with score 0;
if nothing is labelled, every text is. Repeated rows get equal results, ties go
to the language first in order, other columns are ignored, and an empty table
gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
DEPTH = 8
PAD = 256
UNKNOWN = "und"


@dataclass
class ByteNetwork:
    langs: list[str]
    embed: np.ndarray  # (257, DEPTH), the last row zero: padding
    filters: list[np.ndarray]  # of each width (width, DEPTH, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray  # (FILTERS * widths, languages)
    out_bias: np.ndarray

    def tables(self) -> list[np.ndarray]:
        """Embeddings times filters: what each byte adds at each place of a filter."""
        return [np.einsum("bd,wdf->wbf", self.embed, f).astype(np.float32) for f in self.filters]

    def answers(self, windows: np.ndarray, tables=None, places: bool = False):
        """Each filter's largest answer in each window (and where it begins)."""
        kept, where = [], []
        for table, bias in zip(tables or self.tables(), self.bias):
            width = len(table)
            span = windows.shape[1] - width + 1
            total = table[0][windows[:, :span]]
            for j in range(1, width):
                total += table[j][windows[:, j : j + span]]
            if places:
                where.append(total.argmax(axis=1))
            kept.append(total.max(axis=1) + bias)
        return (np.concatenate(kept, axis=1), where) if places else np.concatenate(kept, axis=1)

    def shares(self, windows: np.ndarray, tables=None) -> np.ndarray:
        scores = np.maximum(self.answers(windows, tables), 0) @ self.out + self.out_bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over whole texts (none empty), padded; each window's bytes; each text's first window."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts])
    out = np.full((int(counts.sum()), WINDOW), PAD, dtype=np.int16)
    firsts = np.cumsum(counts) - counts
    flat, sizes = out.ravel(), []
    for text, first, count in zip(texts, firsts, counts):
        flat[first * WINDOW : first * WINDOW + len(text)] = np.frombuffer(text, dtype=np.uint8)
        sizes += [WINDOW] * (count - 1) + [len(text) - (count - 1) * WINDOW]
    return out, np.array(sizes, dtype=np.float64), firsts


def train(examples: list[tuple[str, bytes]], epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 7):
    """Fit the network to (language, text window) pairs by Adam on the cross entropy."""
    langs = sorted({lang for lang, _ in examples})
    target = np.array([langs.index(lang) for lang, _ in examples])
    windows = cut([text[:WINDOW] for _, text in examples])[0]
    rng = np.random.default_rng(seed)
    many = FILTERS * len(WIDTHS)
    weights = [rng.normal(0, 0.5, (257, DEPTH))]
    weights += [rng.normal(0, (w * DEPTH) ** -0.5, (w, DEPTH, FILTERS)) for w in WIDTHS]
    weights += [np.zeros(FILTERS) for _ in WIDTHS]
    weights += [rng.normal(0, many**-0.5, (many, len(langs))), np.zeros(len(langs))]
    weights[0][PAD] = 0
    mean, spread, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    k = len(WIDTHS)

    def network() -> ByteNetwork:
        return ByteNetwork(langs, weights[0], weights[1 : 1 + k], weights[1 + k : 1 + 2 * k], weights[-2], weights[-1])

    for _ in range(epochs):
        for chosen in np.array_split(rng.permutation(len(target)), max(1, len(target) // batch)):
            x = windows[chosen].copy()
            for row, keep in zip(x, rng.integers(24, 2 * WINDOW, len(x))):  # short texts are met as well
                row[keep:] = PAD
            net = network()
            answers, where = net.answers(x, places=True)
            hidden = np.maximum(answers, 0)
            scores = hidden @ net.out + net.out_bias
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            wrong = scores / scores.sum(axis=1, keepdims=True)
            wrong[np.arange(len(x)), target[chosen]] -= 1
            wrong /= len(x)
            back = (wrong @ net.out.T) * (answers > 0)
            grads = [np.zeros_like(w) for w in weights]
            grads[-2], grads[-1] = hidden.T @ wrong, wrong.sum(axis=0)
            rows = np.arange(len(x))[:, None]
            for i, width in enumerate(WIDTHS):
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                grads[1 + k + i] = part.sum(axis=0)
                for j in range(width):
                    byte = x[rows, where[i] + j]  # (texts, filters): what stood where the answer was largest
                    grads[1 + i][j] = np.einsum("nfd,nf->df", weights[0][byte], part)
                    pull = part[:, :, None] * weights[1 + i][j].T[None]
                    np.add.at(grads[0], byte.ravel(), pull.reshape(-1, DEPTH))
            grads[0][PAD] = 0
            step += 1
            for w, g, m, v in zip(weights, grads, mean, spread):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network()


def learn(
    labelled: DataFrame, per_language: int = 800, languages: int = 256, key: str = "doc_id", text: str = "text",
    lang: str = "lang",
) -> ByteNetwork | None:
    """Train on about ``per_language`` texts, chosen by hash, of each of the most frequent ``languages``.

    Three windows of each chosen text (its start, middle and end) come to the driver: with the
    defaults at most 256 x 2 x 800 x 3 windows of 256 characters, and with four languages 2.5 MB.
    """
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "lang IS NOT NULL AND text IS NOT NULL AND text != ''"
    )
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return None
    rate = F.coalesce(*[F.when(F.col("lang") == c.lang, F.lit(per_language / c["count"])) for c in counts])
    unit = F.pmod(F.xxhash64("key", F.length("text")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    size = F.char_length("text")
    starts = F.array(F.lit(1), F.greatest(F.lit(1), size.cast("bigint") / 2).cast("int"), F.greatest(F.lit(1), size - WINDOW + 1))
    windows = (
        rows.withColumn("unit", unit)
        .where(F.col("unit") < rate)
        .select("unit", "lang", F.explode(F.array_distinct(F.transform(starts, lambda s: F.substr("text", s, F.lit(WINDOW))))).alias("window"))
        .orderBy("unit", "lang", "window")
        .limit(2 * per_language * len(counts) * 3)
        .collect()
    )
    examples = [(w.lang, w.window.encode()) for w in windows if w.window]
    return train(examples) if examples else None


def predict_language(
    docs: DataFrame, network: ByteNetwork | None, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (),
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """(key, carried columns, then as named): the language with the largest share of the whole text, and that share."""
    tables = network.tables() if network else None
    kept = [key, *carry]
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept)

    def run(batches):
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if network and t and any(map(str.isalpha, t))]
            if known:
                windows, sizes, firsts = cut([texts[i].encode() for i in known])
                shares = np.concatenate([network.shares(windows[i : i + 128], tables) for i in range(0, len(windows), 128)])
                total = np.add.reduceat(shares * sizes[:, None], firsts) / np.add.reduceat(sizes, firsts)[:, None]
                for i, share in zip(known, total):
                    langs[i], scores[i] = network.langs[share.argmax()], float(min(1.0, share.max()))
            columns = [*batch.columns[: len(kept)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return docs.select(*kept, text).mapInArrow(run, kinds + f"`{names[0]}` string, `{names[1]}` double")


def held_out(key: Column) -> Column:
    """Documents the network never learns from."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(3)) == 1, F.lit(False))
