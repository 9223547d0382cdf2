"""Language identification with a byte convolutional network, trained here in numpy.

Filters of several widths slide over the UTF-8 bytes of a window; the largest response of each
filter in the window goes to a softmax over the languages. Texts are cut into windows of fixed
length, every window of every text is read, and a text's posterior is the mean of its windows'
log-posteriors, weighted by their bytes, as a distribution again.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farewind.llm.arrow_text import LOWER, pieces, text_bytes

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Labelled texts per language that a network learns from (expected number), windows of each.
TEXTS_PER_LANGUAGE = 500
WINDOWS_PER_TEXT = 6

UNKNOWN = "und"
_PAD = 0
_BLOCK = 256  # windows read at once


def _codes() -> np.ndarray:
    """Bytes as symbols: 0 is padding; A to Z count as a to z, digits as one, controls as blank."""
    table = LOWER.astype(np.int64) + 1
    table[:33] = 33
    table[48:58] = 49
    return table


CODES = _codes()
SYMBOLS = 257


def window_index(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of all texts: the text, where it starts and its number of bytes."""
    sizes = np.diff(offsets)
    n = -(-sizes // WINDOW)
    text = np.repeat(np.arange(len(sizes)), n)
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[text] + number * WINDOW
    return text, start, np.minimum(offsets[text + 1] - start, WINDOW)


def symbols_at(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The symbols (n, WINDOW) of windows, padded."""
    at = start[:, None] + np.arange(WINDOW)
    symbols = CODES[data.take(at, mode="clip")]
    symbols[np.arange(WINDOW) >= length[:, None]] = _PAD
    return symbols


class Network:
    """Tables of filter responses per width, offset and symbol; softmax weights."""

    def __init__(self, languages: list[str], tables: list[np.ndarray], bias: np.ndarray, out: np.ndarray, out_bias: np.ndarray):
        self.languages, self.tables, self.bias, self.out, self.out_bias = languages, tables, bias, out, out_bias

    @classmethod
    def fresh(cls, languages: list[str], seed: int) -> Network:
        rng = np.random.default_rng(seed)
        tables = [rng.normal(0, 0.3, (w, SYMBOLS, FILTERS)).astype(np.float32) for w in WIDTHS]
        for table in tables:
            table[:, _PAD] = 0
        n = FILTERS * len(WIDTHS)
        out = rng.normal(0, 0.3, (n, len(languages))).astype(np.float32)
        return cls(languages, tables, np.zeros(n, np.float32), out, np.zeros(len(languages), np.float32))

    def pooled(self, symbols: np.ndarray, places: bool = False):
        """Largest response of every filter in each window, and with ``places`` where it was."""
        best, where = [], []
        for width, table in zip(WIDTHS, self.tables):
            n = WINDOW - width + 1
            response = table[0].take(symbols[:, :n], axis=0, mode="clip")
            for k in range(1, width):
                response += table[k].take(symbols[:, k : k + n], axis=0, mode="clip")
            if places:
                at = response.argmax(axis=1)
                where.append(at)
                best.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0])
            else:
                best.append(_largest(response))
        hidden = np.maximum(np.concatenate(best, axis=1) + self.bias, 0)
        return (hidden, where) if places else hidden

    def log_posteriors(self, symbols: np.ndarray) -> np.ndarray:
        return _log_softmax(self.pooled(symbols) @ self.out + self.out_bias)

    def train(self, symbols: np.ndarray, labels: np.ndarray, epochs: int, rate: float, seed: int) -> None:
        """Adam on the cross-entropy; gradients reach a filter where it responded most."""
        rng = np.random.default_rng(seed)
        params = [*self.tables, self.bias, self.out, self.out_bias]
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(symbols))
            for begin in range(0, len(order), 128):
                rows = order[begin : begin + 128]
                grads = self._gradients(symbols[rows], labels[rows])
                step += 1
                for p, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)

    def _gradients(self, symbols: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        hidden, where = self.pooled(symbols, places=True)
        n = len(symbols)
        error = np.exp(_log_softmax(hidden @ self.out + self.out_bias))
        error[np.arange(n), labels] -= 1
        error /= n
        back = (error @ self.out.T) * (hidden > 0)
        filters, grads = np.arange(FILTERS), []
        for i, (width, table) in enumerate(zip(WIDTHS, self.tables)):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            grad = np.zeros_like(table)
            for k in range(width):
                seen = np.take_along_axis(symbols, where[i] + k, axis=1)
                np.add.at(grad[k], (seen, filters), part)
            grad[:, _PAD] = 0
            grads.append(grad)
        return [*grads, back.sum(0), hidden.T @ error, error.sum(0)]


def _largest(response: np.ndarray) -> np.ndarray:
    """Maximum over the middle axis by halving, which keeps the reads contiguous."""
    while response.shape[1] > 1:
        half = response.shape[1] // 2
        folded = np.maximum(response[:, :half], response[:, half : 2 * half])
        if response.shape[1] % 2:
            np.maximum(folded[:, :1], response[:, -1:], out=folded[:, :1])
        response = folded
    return response[:, 0]


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _sampled_windows(batches):
    """Up to WINDOWS_PER_TEXT windows of each text, spread evenly over the whole of it."""
    for batch in batches:
        for piece in pieces(batch):
            data, offsets = text_bytes(piece.column("text"))
            sizes = np.diff(offsets)
            keys, langs = piece.column("key").to_pylist(), piece.column("lang").to_pylist()
            out_key, out_lang, out_bytes = [], [], []
            for i, size in enumerate(sizes):
                n = min(WINDOWS_PER_TEXT, -(-int(size) // WINDOW))
                for at in np.linspace(0, max(0, int(size) - WINDOW), n).astype(int) if n else ():
                    begin = offsets[i] + at
                    out_key.append(keys[i])
                    out_lang.append(langs[i])
                    out_bytes.append(data[begin : min(begin + WINDOW, offsets[i + 1])].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_key, pa.int64()), pa.array(out_lang, pa.string()), pa.array(out_bytes, pa.binary())],
                names=["key", "lang", "bytes"],
            )


def fit(
    labelled: DataFrame, texts_per_language: int = TEXTS_PER_LANGUAGE, epochs: int = 12, seed: int = 7
) -> Network | None:
    """A network trained on a sample of ``labelled`` (text, lang); None without a usable row.

    A hash of text and language chooses about ``texts_per_language`` texts of each language;
    the driver gets WINDOWS_PER_TEXT windows of each at most, and counts per language. Rows
    with a null text or language are not used; repeated rows are chosen or left together.
    """
    usable = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    counts = usable.groupBy("lang").count().collect()
    if not counts:
        return None
    languages = sorted(row["lang"] for row in counts)
    key = F.xxhash64("text", "lang", F.lit(seed))
    share = (F.pmod(key, F.lit(1_000_000)) / 1_000_000.0).cast("double")
    wanted = functools.reduce(
        lambda when, row: when.when(F.col("lang") == row["lang"], texts_per_language / row["count"]),
        counts[1:],
        F.when(F.col("lang") == counts[0]["lang"], texts_per_language / counts[0]["count"]),
    )
    chosen = usable.select("text", "lang", key.alias("key")).filter(share < wanted)
    rows = chosen.mapInArrow(_sampled_windows, "key bigint, lang string, bytes binary").toPandas()
    rows = rows.sort_values(["key", "lang", "bytes"], kind="stable")
    if not len(rows):
        return None
    rng = np.random.default_rng(seed)
    number = {lang: i for i, lang in enumerate(languages)}
    labels = rows["lang"].map(number).to_numpy()
    # each window once whole and once cut to a random length, so that short texts are known too
    whole = rows["bytes"].tolist()
    short = [b[: rng.integers(min(12, len(b)), len(b) + 1)] for b in whole]
    data = np.frombuffer(b"".join([*whole, *short]), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in [*whole, *short]])])
    owner, start, length = window_index(offsets)
    symbols = symbols_at(data, start, length)
    labels = np.concatenate([labels, labels])[owner]
    network = Network.fresh(languages, seed)
    network.train(symbols, labels, epochs, 0.01, seed)
    return network


def _predictor(shared):
    def predict(batches):
        network = shared.value
        languages = np.array(network.languages, dtype=object)
        for batch in batches:
            for piece in pieces(batch):
                data, offsets = text_bytes(piece.column("text"))
                total = np.zeros((piece.num_rows, len(languages)), np.float64)
                weight = np.zeros(piece.num_rows)
                text, start, length = window_index(offsets)
                for at in range(0, len(text), _BLOCK):
                    part = slice(at, at + _BLOCK)
                    symbols = symbols_at(data, start[part], length[part])
                    scores = network.log_posteriors(symbols) * length[part, None]
                    np.add.at(total, text[part], scores)
                    np.add.at(weight, text[part], length[part])
                mean = np.exp(_log_softmax(total / np.maximum(weight, 1)[:, None]))
                best = mean.argmax(axis=1)
                names = piece.schema.names
                columns = [c for c, name in zip(piece.columns, names) if name != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(languages[best], pa.string()), pa.array(mean[np.arange(len(best)), best], pa.float64())],
                    names=[*[n for n in names if n != "text"], "_lang", "_score"],
                )

    return predict


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(rows: DataFrame, network: Network | None) -> DataFrame:
    """The columns of ``rows`` but ``text``, and lang_pred and score.

    A text that is null or has no letter gets ``und`` with score 1; so does every text when
    there is no network, with score 0. Nothing but the text is looked at.
    """
    if network is None:
        lettered = has_letter(F.col("text"))
        return rows.select(
            *[F.col(f"`{c}`") for c in rows.columns if c != "text"],
            F.lit(UNKNOWN).alias("lang_pred"),
            F.when(lettered, 0.0).otherwise(1.0).alias("score"),
        )
    shared = rows.sparkSession.sparkContext.broadcast(network)
    marked = rows.withColumn("_lettered", has_letter(F.col("text")))
    kept = [f for f in marked.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    scored = marked.mapInArrow(_predictor(shared), f"{schema}, _lang string, _score double")
    return scored.select(
        *[F.col(f"`{c}`") for c in rows.columns if c != "text"],
        F.when(F.col("_lettered"), F.col("_lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("_lettered"), F.col("_score")).otherwise(1.0).alias("score"),
    )


def held_out(doc_id: Column) -> Column:
    """Whether the row is kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``docs`` (doc_id, text, lang).

    Trained on the rows that are not held out and have a language (a null doc_id is not held
    out). Runs jobs when called.
    """
    network = fit(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(rows, network)


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose language is found with ``min_score`` at least; columns as they were."""
    network = fit(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    judged = predict(whole, network)
    if network is None:  # nothing to learn from: only texts without letters go
        return judged.filter("score = 0").select("row.*")
    return judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")
