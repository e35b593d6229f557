"""Language identification by a bidirectional gated recurrent network over bytes.

Every byte enters the gates through its own input row; one GRU reads forward,
one backward; each position's two states give language probabilities, and a
document's probabilities are the mean over all positions of its whole text.
Texts run in sequences of ``SEQUENCE`` bytes, thousands side by side.

The network is trained here with numpy by backpropagation through time, on a
bounded sample: of each language at most ``SAMPLE_DOCS`` labelled documents
drawn by id hash, and of each at most ``SAMPLE_CHARS`` characters from its
middle. ``SAMPLE_DOCS`` shrinks when there are over ``SAMPLE_LANGS``
languages. Prediction has no bounds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import common as C

STATES = 8
SEQUENCE = 256
SIDE_BY_SIDE = 2048
PAD = 256
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_LANGS = 256, 2048, 32
STEPS, TRAIN_ROWS, TRAIN_BYTES, RATE, SEED = 300, 256, 64, 0.02, 5
NO_LANGUAGE = "und"
_LETTER = regex.compile(r"\p{L}")


# --- the network --------------------------------------------------------------

def new_weights(langs: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Per direction: input rows x of r, z and candidate (257, 3H), recurrent
    weights u of r and z (H, 2H) and v of the candidate (H, H). Output o, b."""
    w = {}
    for d in "fb":
        w["x" + d] = rng.normal(0, 0.3, (PAD + 1, 3 * STATES))
        w["u" + d] = rng.normal(0, 0.3, (STATES, 2 * STATES))
        w["v" + d] = rng.normal(0, 0.3, (STATES, STATES))
    w["o"] = rng.normal(0, 0.3, (2 * STATES, langs))
    w["b"] = np.zeros(langs)
    return {k: a.astype(np.float32) for k, a in w.items()}


def _sigmoid(a):
    return 0.5 + 0.5 * np.tanh(0.5 * a)


def _forward(w, d: str, ids: np.ndarray):
    """States of one direction over ids (T, B), and what the backward pass needs."""
    H, h, kept, out = STATES, np.zeros((ids.shape[1], STATES), np.float32), [], []
    for step in ids:
        x = w["x" + d][step]
        g = _sigmoid(h @ w["u" + d] + x[:, :2 * H])
        r, z, c = g[:, :H], g[:, H:], h @ w["v" + d]
        n = np.tanh(x[:, 2 * H:] + r * c)
        kept.append((h, r, z, c, n))
        h = n + z * (h - n)
        out.append(h)
    return np.stack(out), kept


def _backward(w, d: str, ids: np.ndarray, kept, grad_out: np.ndarray, grads: dict) -> None:
    """Gradients of one direction by backpropagation through time."""
    H, rows = STATES, np.empty((*ids.shape, 3 * STATES), np.float32)
    u, v = w["u" + d], w["v" + d]
    du, dv, dh = np.zeros_like(u), np.zeros_like(v), np.zeros(grad_out.shape[1:], np.float32)
    for t in range(len(ids) - 1, -1, -1):
        h, r, z, c, n = kept[t]
        dh = dh + grad_out[t]
        dn = dh * (1 - z) * (1 - n * n)
        da = np.concatenate((dn * c * r * (1 - r), dh * (h - n) * z * (1 - z)), axis=1)
        dc = dn * r
        rows[t, :, :2 * H], rows[t, :, 2 * H:] = da, dn
        du += h.T @ da
        dv += h.T @ dc
        dh = dh * z + da @ u.T + dc @ v.T
    flat, order = ids.ravel(), np.argsort(ids.ravel(), kind="stable")
    seen, first = np.unique(flat[order], return_index=True)
    dx = np.zeros_like(w["x" + d])
    dx[seen] = np.add.reduceat(rows.reshape(-1, 3 * H)[order], first, axis=0)
    grads["x" + d], grads["u" + d], grads["v" + d] = dx, du, dv


def gradients(w, ids: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy over all positions of ids (T, B), and its gradients."""
    hf, kf = _forward(w, "f", ids)
    hb, kb = _forward(w, "b", ids[::-1])
    both = np.concatenate((hf, hb[::-1]), axis=2)
    logits = both @ w["o"] + w["b"]
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    cols = np.arange(ids.shape[1])
    loss = -float(np.log(np.maximum(p[:, cols, labels], 1e-12)).mean())
    p[:, cols, labels] -= 1
    p /= ids.size
    grads = {"o": np.einsum("tbh,tbl->hl", both, p), "b": p.sum(axis=(0, 1))}
    dh = p @ w["o"].T
    _backward(w, "f", ids, kf, dh[:, :, :STATES], grads)
    _backward(w, "b", ids[::-1], kb, dh[::-1, :, STATES:], grads)
    return loss, grads


def train(texts: list[tuple[str, str]], steps: int = STEPS) -> tuple[list[str], dict]:
    """(text, language) pairs -> languages in order, weights. Adam, a fixed seed."""
    langs = sorted({lang for _, lang in texts})
    rng = np.random.default_rng(SEED)
    w = new_weights(len(langs), rng)
    if len(langs) < 2:
        return langs, w
    pieces: list[list[np.ndarray]] = [[] for _ in langs]
    for text, lang in texts:
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        for i in range(0, max(1, len(raw) - TRAIN_BYTES + 1), TRAIN_BYTES):
            cut = np.full(TRAIN_BYTES, 32, np.uint8)        # short texts are filled up with blanks
            cut[:len(raw[i:i + TRAIN_BYTES])] = raw[i:i + TRAIN_BYTES]
            pieces[langs.index(lang)].append(cut)
    mats = [np.stack(p) for p in pieces]
    m1, m2 = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        labels = rng.integers(0, len(langs), TRAIN_ROWS)
        ids = np.stack([mats[k][rng.integers(len(mats[k]))] for k in labels]).T.astype(np.intp)
        _, g = gradients(w, ids, labels)
        size = float(np.sqrt(sum(float((a * a).sum()) for a in g.values())))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, a in g.items():
            a = a * min(1.0, 1.0 / max(size, 1e-12))
            m1[k] = 0.9 * m1[k] + 0.1 * a
            m2[k] = 0.999 * m2[k] + 0.001 * a * a
            w[k] = (w[k] - rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return langs, w


class Reader:
    """The trained network for whole texts: states lie in rows, sequences in
    columns, and the halves of the sigmoids are folded into the weights."""

    def __init__(self, langs: list[str], w: dict):
        H = STATES
        self.langs, self.dirs = langs, []
        for d in "fb":
            x, u = w["x" + d].copy(), w["u" + d].T.copy()
            x[:, :2 * H] *= 0.5
            x[PAD] = 0
            x[PAD, H:2 * H] = 20          # update gate 1: padding leaves the state as it is
            self.dirs.append((x, np.ascontiguousarray(0.5 * u), np.ascontiguousarray(0.5 * w["v" + d].T)))
        self.of = np.ascontiguousarray(w["o"][:H].T)
        self.ob = np.ascontiguousarray(w["o"][H:].T)
        self.bias = w["b"][:, None]

    def _steps(self, d: int, ids: np.ndarray):
        """States (H, B) after each of the id rows (T, B); one buffer, overwritten."""
        H, n_cols = STATES, ids.shape[1]
        x, u, v = self.dirs[d]
        h, g, n = (np.zeros((k, n_cols), np.float32) for k in (H, 2 * H, H))
        rows = np.empty((n_cols, 3 * H), np.float32)
        for step in ids:
            np.take(x, step, axis=0, out=rows, mode="clip")
            into = rows.T
            np.matmul(u, h, out=g)
            g += into[:2 * H]
            np.tanh(g, out=g)
            g += 1                        # twice the gates
            np.matmul(v, h, out=n)
            n *= g[:H]
            n += into[2 * H:]
            np.tanh(n, out=n)
            h -= n
            g[H:] *= 0.5
            h *= g[H:]
            h += n
            yield h

    def sums(self, ids: np.ndarray) -> np.ndarray:
        """(B, languages): probabilities summed over the unpadded positions of ids (T, B)."""
        ahead = np.empty((len(ids), len(self.langs), ids.shape[1]), np.float32)
        for t, h in enumerate(self._steps(0, ids)):
            np.matmul(self.of, h, out=ahead[t])
        total = np.zeros((len(self.langs), ids.shape[1]), np.float32)
        for t, h in zip(range(len(ids) - 1, -1, -1), self._steps(1, ids[::-1]), strict=True):
            p = np.matmul(self.ob, h)
            p += ahead[t]
            p += self.bias
            np.clip(p, -40, 40, out=p)
            np.exp(p, out=p)
            p *= (ids[t] != PAD) / p.sum(axis=0)
            total += p
        return total.T

    def read(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities of each text, which must not be empty."""
        raw = [np.frombuffer(t.encode("utf-8"), np.uint8) for t in texts]
        out = np.zeros((len(texts), len(self.langs)))
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for k, r in enumerate(raw):
            for i in range(0, len(r), SEQUENCE):
                cut = r[i:i + SEQUENCE]
                by_size.setdefault(-(-len(cut) // 32) * 32, []).append((k, cut))
        for size, cuts in by_size.items():
            for i in range(0, len(cuts), SIDE_BY_SIDE):
                part = cuts[i:i + SIDE_BY_SIDE]
                ids = np.full((len(part), size), PAD, np.intp)
                for j, (_, cut) in enumerate(part):
                    ids[j, :len(cut)] = cut
                np.add.at(out, [k for k, _ in part], self.sums(np.ascontiguousarray(ids.T)))
        return out / np.array([[max(1, len(r))] for r in raw])


# --- Spark --------------------------------------------------------------------

def held_out(doc_id):
    """Documents that are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame) -> list[tuple[str, str]]:
    """The bounded sample of labelled documents that are not held out.

    Counts per language come first; about twice the wanted documents are then
    drawn by id hash, so that only these are shuffled, however many documents
    a language has."""
    ok = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out(F.col("doc_id")))
    per = C.stored(ok.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")), "language-counts")
    each = max(8, SAMPLE_DOCS * SAMPLE_LANGS // max(SAMPLE_LANGS, per.count()))
    drawn = ok.join(C.small(per), "lang").where(F.pmod(F.xxhash64("doc_id"), F.col("docs")) < 2 * each)
    middle = F.greatest(F.lit(1), ((F.length("text") - SAMPLE_CHARS) / 2).cast("int") + 1)
    cut = drawn.where(F.regexp_like("text", F.lit(r"\p{L}"))).select(
        "lang", "doc_id", F.xxhash64("text").alias("tie"), F.substr("text", middle, F.lit(SAMPLE_CHARS)).alias("text"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "tie")
    rows = cut.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= each).select("text", "lang").collect()
    return sorted((r["text"], r["lang"]) for r in rows)


def predicted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              steps: int = STEPS) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per input row.

    Languages are the non-null labels of documents that are not held out; a
    document's own label, source and id play no part in its prediction. Null
    texts and texts without a letter give ``und`` with score 0, as does every
    text when nothing is labelled. Equal probabilities go to the first
    language in order. Rows with a null id are predicted, never learnt from.
    Repeated rows get the same result; other columns are not read.
    """
    C.prepare(docs.sparkSession)
    own = C.ids_only(docs, id_col, text_col, lang_col)
    langs, weights = train(training_rows(own), steps)

    def run(batches):
        reader = Reader(langs, weights)
        for pdf in batches:
            texts = pdf["text"].tolist()
            lang, score = [NO_LANGUAGE] * len(texts), np.zeros(len(texts))
            some = [k for k, t in enumerate(texts) if langs and t and _LETTER.search(t)]
            if some:
                p = reader.read([texts[k] for k in some])
                best = p.argmax(axis=1)
                for k, b, q in zip(some, best, p[np.arange(len(some)), best], strict=True):
                    lang[k], score[k] = langs[b], min(1.0, float(q))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "lang_pred": lang, "score": score})

    rows = own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double")
