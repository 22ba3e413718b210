"""Language identification by a byte convolutional network, trained in numpy.

Model: byte embedding, convolutions of several widths, ReLU, max pooling over a
window of fixed length, softmax over the learned languages. Trained by Adam on
windows of a bounded labelled sample (``docs_per_lang`` documents a language in
expectation, ``windows_per_doc`` windows each, spread over the whole text; some
windows are shortened so that short texts are known too).

Applied to whole texts: every text is cut into windows of ``LENGTH`` bytes that
overlap by the longest filter less one, so each byte n-gram is read exactly
once; the windows of many texts form one batch. A text's language is the
softmax of its windows' mean log-probabilities, weighted by their bytes.

For applying, the convolutions are folded into two tables over byte pairs
(``width <= 4``): a position costs two table rows instead of products.

Null texts and texts without a letter: ``und`` with score 0. Rows with a null
or empty language teach nothing, nor do windows of fewer than ``LEAST`` bytes (so
texts shorter than that): a language without a longer text is not learned, and if
none is, every text is ``und``. Languages beyond the ``max_langs`` most frequent are
not learned either. Repeated rows are rows like any others and get one answer; an
empty table gives an empty result; texts of any length are read whole, window by
window. Extra columns are carried through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

LENGTH = 256
WIDTHS = (2, 3, 4)
#: Bytes a window needs to teach anything.
LEAST = 12
LETTER = regex.compile(r"\p{L}")
UNDETERMINED = "und"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def cut(data: list[bytes], step: int = LENGTH - max(WIDTHS) + 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fixed-length windows over whole texts: (windows, text of each, bytes of each)."""
    lens = np.array([len(x) for x in data], np.int64)
    counts = np.maximum(1, -(-(lens - max(WIDTHS) + 1) // step))
    owner = np.repeat(np.arange(len(data)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    left = np.clip(lens[owner] - nth * step, 0, LENGTH)
    buf = np.zeros(int(lens.sum()) + LENGTH, np.uint8)
    buf[: lens.sum()] = _LOWER[np.frombuffer(b"".join(data), np.uint8)]
    at = (np.cumsum(lens) - lens)[owner] + nth * step
    x = buf[at[:, None] + np.arange(LENGTH)]
    x[np.arange(LENGTH) >= left[:, None]] = 0
    return x, owner, left


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray  # (256, d)
    filters: dict[int, np.ndarray]  # width -> (width, d, f)
    bias: dict[int, np.ndarray]
    out: np.ndarray  # (features, langs)
    out_bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Filter responses by the byte pair at a position, and two positions on."""
        by = {w: [self.embed @ f for f in fs] for w, fs in self.filters.items()}
        zero = np.zeros((256, 1), np.float32)
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        first = [pair(by[w][0] + self.bias[w], by[w][1]) for w in WIDTHS]
        second = [pair(by[w][2], by[w][3] if w > 3 else zero) for w in WIDTHS if w > 2]
        return np.concatenate(first, 1).astype(np.float32), np.concatenate(second, 1).astype(np.float32)

    def log_probs(self, x: np.ndarray, tables=None, block: int = 48) -> np.ndarray:
        """Log-probabilities by window."""
        first, second = tables or self.tables()
        skip = first.shape[1] - second.shape[1]
        pooled = np.empty((len(x), first.shape[1]), np.float32)
        for i in range(0, len(x), block):
            b = x[i : i + block].astype(np.int32)
            pair = (b[:, :-1] << 8) | b[:, 1:]
            act = first[pair[:, :-2]]
            act[:, :, skip:] += second[pair[:, 2:]]
            pooled[i : i + block] = act.max(axis=1)
        z = np.maximum(pooled, 0) @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def predict(self, texts: list[str | None], tables=None, limit: int = 2 << 20) -> tuple[list[str], list[float]]:
        """Language and score of each whole text."""
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t is not None and self.langs and LETTER.search(t)]
        tables = tables or (self.tables() if known else None)
        while known:
            some, size = [], 0
            while known and (not some or size < limit):
                some.append(known.pop())
                size += len(texts[some[-1]])
            x, owner, left = cut([texts[i].encode() for i in some])
            total = np.zeros((len(some), len(self.langs)))
            np.add.at(total, owner, self.log_probs(x, tables) * left[:, None])
            z = total / np.maximum(1, np.bincount(owner, left, len(some)))[:, None]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for i, q in zip(some, p):
                langs[i], scores[i] = self.langs[int(q.argmax())], float(q.max())
        return langs, scores


def train(x: np.ndarray, y: np.ndarray, langs: list[str], dim: int = 8, n_filters: int = 8, epochs: int = 12, batch: int = 128, rate: float = 4e-3, seed: int = 11) -> Network:
    """Fit the network on windows ``x`` (n, LENGTH) with language numbers ``y``."""
    rng = np.random.default_rng(seed)
    p: dict[str, np.ndarray] = {"embed": rng.normal(0, 0.5, (256, dim))}
    for w in WIDTHS:
        p[f"f{w}"] = rng.normal(0, 1 / np.sqrt(w * dim), (w, dim, n_filters))
        p[f"b{w}"] = np.zeros(n_filters)
    p["out"] = rng.normal(0, 0.2, (n_filters * len(WIDTHS), len(langs)))
    p["out_bias"] = np.zeros(len(langs))
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, s = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    weight = len(y) / (len(langs) * np.maximum(1, np.bincount(y, minlength=len(langs))))
    step, most = 0, LENGTH - max(WIDTHS) + 1
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            xb, yb = x[order[i : i + batch]], y[order[i : i + batch]]
            n = len(xb)
            e = p["embed"][xb]
            feats, where = [], []
            for w in WIDTHS:
                act = sum(e[:, j : j + most] @ p[f"f{w}"][j] for j in range(w)) + p[f"b{w}"]
                at = act.argmax(axis=1)
                feats.append(np.take_along_axis(act, at[:, None], 1)[:, 0])
                where.append(at)
            pooled = np.concatenate(feats, 1)
            h = np.maximum(pooled, 0)
            z = h @ p["out"] + p["out_bias"]
            q = np.exp(z - z.max(axis=1, keepdims=True))
            q /= q.sum(axis=1, keepdims=True)
            dz = q
            dz[np.arange(n), yb] -= 1
            dz *= (weight[yb] / n)[:, None]
            g = {"out": h.T @ dz, "out_bias": dz.sum(axis=0), "embed": np.zeros_like(p["embed"])}
            dh = (dz @ p["out"].T) * (pooled > 0)
            for k, w in enumerate(WIDTHS):
                d = dh[:, k * n_filters : (k + 1) * n_filters]
                g[f"b{w}"], g[f"f{w}"] = d.sum(axis=0), np.zeros_like(p[f"f{w}"])
                for j in range(w):  # only the pooled positions have a gradient
                    b = np.take_along_axis(xb, where[k] + j, 1)
                    g[f"f{w}"][j] = np.einsum("nfd,nf->df", p["embed"][b], d)
                    np.add.at(g["embed"], b, d[:, :, None] * p[f"f{w}"][j].T[None])
            step += 1
            lr = rate * (1 - epoch / epochs)
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.99 * s[k] + 0.01 * g[k] ** 2
                p[k] = (p[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return Network(langs, p["embed"], {w: p[f"f{w}"] for w in WIDTHS}, {w: p[f"b{w}"] for w in WIDTHS}, p["out"], p["out_bias"])


def fit(docs: DataFrame, train_rows=None, docs_per_lang: int = 400, windows_per_doc: int = 6, max_langs: int = 500, seed: int = 11) -> Network:
    """Train on a bounded sample of ``docs`` (doc_id, text, lang) where ``train_rows`` holds (all, if None).

    Bounds: about ``docs_per_lang`` rows for each of the ``max_langs`` most
    frequent languages, taken by a hash of doc_id and text length.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.filter((F.lit(True) if train_rows is None else train_rows) & F.col("lang").isNotNull() & (F.col("lang") != "") & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()}
    nothing = Network([], np.zeros((256, 1)), {}, {}, np.zeros((1, 0)), np.zeros(0))
    if not counts:
        return nothing
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, docs_per_lang / n)))])
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.length("text")), F.lit(1_000_000)) / 1_000_000
    rows = rows.filter(draw < F.coalesce(share[F.col("lang")], F.lit(0.0))).select("lang", "text").limit(2 * docs_per_lang * len(counts))

    def windows(batches):
        for pdf in batches:
            got: list[tuple[str, bytes]] = []
            for lang, text in zip(pdf["lang"], pdf["text"]):
                if LETTER.search(text):
                    x, _, left = cut([text.encode()])
                    pick = np.unique(np.linspace(0, len(x) - 1, windows_per_doc).astype(int))
                    got += [(lang, x[i].tobytes()) for i in pick if left[i] >= LEAST]
            yield pd.DataFrame({"lang": pd.Series([g[0] for g in got], dtype=object), "w": pd.Series([g[1] for g in got], dtype=object)})

    got = sorted((r["lang"], bytes(r["w"])) for r in rows.mapInPandas(windows, "lang string, w binary").collect())
    langs = sorted({k for k, _ in got})
    if not langs:
        return nothing
    y = np.array([langs.index(k) for k, _ in got], np.int64)
    x = np.frombuffer(b"".join(w for _, w in got), np.uint8).reshape(len(got), LENGTH).copy()
    rng = np.random.default_rng(seed)
    short = rng.random(len(x)) < 0.3  # as short as some texts are
    keep = np.where(short, rng.integers(LEAST, LENGTH, len(x)), LENGTH)
    x[np.arange(LENGTH) >= keep[:, None]] = 0
    return train(x, y, langs, seed=seed)


def predict(docs: DataFrame, network: Network, text: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score for every whole text."""
    bounded_batches(docs.sparkSession)
    cache: dict = {}

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        if "tables" not in cache:
            cache["tables"] = network.tables() if network.langs else None
        langs, scores = network.predict(list(texts), cache["tables"])
        return pd.DataFrame({"lang": pd.Series(langs, dtype=object), "score": scores})

    got = "_language"
    while got in docs.columns:
        got = "_" + got
    out = docs.withColumn(got, run.asNondeterministic()(F.col(text)))
    return out.withColumn(lang_col, F.col(f"`{got}`.lang")).withColumn(score_col, F.col(f"`{got}`.score")).drop(got)
