"""Language identification with interpolated Kneser-Ney character models.

One model a language, orders 1 to :data:`ORDER`, over the letters of a word between two boundary
marks.  All models share sorted arrays of n-gram hashes (binary search), whose values hold one number
a language.  As contexts end at word boundaries, the log-probability of a text is the sum over its
words, so each distinct word is looked up once.

A language is the one with the lowest cross-entropy a character.  Its confidence is the posterior under
a temperature calibrated on held-out sentences; a text whose cross-entropy is beyond what held-out
sentences of any language reach is rejected as ``und``.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import spread
from .skeleton import clean

ORDER = 5
#: Labelled sentences per language that the models are fitted on at most (a documented bound; the table is small).
SAMPLES = 5_000
#: Fewest words of a run in one language, and of a text that can be a case.
RUN = 4
#: Cost in nats of changing the language between two words, and where a mark of punctuation stands between them.
#: Lower ones find more runs of four held-out words, but more sound texts come apart (README).
SWITCH, SWITCH_AT_MARK = 16.0, 10.0
UNDETERMINED = "und"

# Spellings of language names and codes, in lower case without region.
SPELLINGS = {
    "bld": "bld balanda",
    "en": "en eng english",
    "fr": "fr fra fre french français francais",
    "es": "es spa spanish español espanol castellano",
    "pt": "pt por portuguese português portugues",
    "de": "de deu ger german deutsch",
    "sw": "sw swa swh swahili kiswahili",
    "ru": "ru rus russian русский",
}
MISSING = {"", "und", "unknown"}

_CODE = {s: code for code, names in SPELLINGS.items() for s in names.split()}
_LETTERS = re.compile(r"[^\W\d_]+(?:['’\u0300-\u036f][^\W\d_]*)*")
_MIX = 0x9E3779B97F4A7C15


def label(text: str | None) -> str | None:
    """The code a label stands for in any spelling; None if it says nothing; an unknown label comes back in lower case."""
    s = (text or "").strip().lower()
    if s in MISSING:
        return None
    return _CODE.get(s) or _CODE.get(re.split(r"[-_]", s)[0], s)


def _hash_steps(codes: np.ndarray, starts: np.ndarray, top: int):
    """For n = 1..top: the hash of the n-gram that ends at each position, and whether it lies within its word."""
    pos = np.arange(len(codes))
    h = np.zeros(len(codes), dtype=np.uint64)
    power, wrap = 1, (1 << 64) - 1
    c = codes.astype(np.uint64) + np.uint64(1)
    for n in range(1, top + 1):
        ok = pos - starts >= n - 1
        shifted = np.zeros_like(c)
        if n <= len(c):
            shifted[n - 1 :] = c[: len(c) - n + 1]
        h = h + shifted * np.uint64(power)
        power = power * _MIX & wrap
        x = h ^ (h >> np.uint64(29))
        yield n, x * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n), ok


def _spell(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of ``_word_`` for all words, the start of the word of each, and where words begin."""
    text = "".join(f" {w} " for w in words)
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    lengths = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(words) else np.zeros(0, dtype=np.int64)
    return codes, np.repeat(begin, lengths), begin


class Models:
    """The models of all languages in shared sorted hash arrays."""

    def __init__(self, samples: dict[str, list[str]], order: int = ORDER):
        self.languages = sorted(samples)
        self.order = order
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []  # per order: sorted hashes, discounted probability per language
        self.contexts: list[tuple[np.ndarray, np.ndarray]] = []  # per order: sorted context hashes, back-off weight per language
        raw = [self._count(samples[lang]) for lang in self.languages]
        alphabet = len({c for lang in self.languages for s in samples[lang] for c in s.lower()}) + 200
        self.floor = 1.0 / alphabet
        for n in range(1, order + 1):
            gh = np.unique(np.concatenate([r[n][0] for r in raw]))
            ch = np.unique(np.concatenate([r[n][1] for r in raw])) if n > 1 else np.zeros(1, dtype=np.uint64)
            gv = np.zeros((len(gh), len(raw)), dtype=np.float64)
            cv = np.ones((len(ch), len(raw)), dtype=np.float64)
            for k, r in enumerate(raw):
                g, c, ctx_of, counts = r[n][0], r[n][1], r[n][2], r[n][3]
                n1, n2 = (counts == 1).sum(), (counts == 2).sum()
                discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
                if n == 1:
                    total, kinds = counts.sum(), len(counts)
                    gv[np.searchsorted(gh, g), k] = (counts - discount) / max(total, 1)
                    cv[0, k] = discount * kinds / total if total else 1.0
                else:
                    total = np.bincount(ctx_of, weights=counts, minlength=len(c))
                    kinds = np.bincount(ctx_of, minlength=len(c))
                    gv[np.searchsorted(gh, g), k] = (counts - discount) / total[ctx_of]
                    cv[np.searchsorted(ch, c), k] = discount * kinds / total
            self.grams.append((gh, gv))
            self.contexts.append((ch, cv))

    def _count(self, sentences: list[str]) -> dict[int, tuple]:
        """Per order: n-gram hashes, context hashes, each n-gram's context, and its count; continuation counts below the top."""
        words = [w for s in sentences for w in map(letters_of, s.split()) if w]
        codes, starts, _ = _spell(words)
        by = {n: (h.copy(), ok.copy()) for n, h, ok in _hash_steps(codes, starts, self.order)}
        out = {}
        for n in range(1, self.order + 1):
            h, ok = by[n]
            inner = np.arange(len(codes)) > starts  # the first mark is context only
            keep = ok & inner
            if n < self.order:
                # continuation: how many different characters stand before the n-gram; at a word's start it counts as itself
                longer, has = by[n + 1]
                pairs = np.unique(np.stack([h[keep & has], longer[keep & has]]), axis=1)[0] if (keep & has).any() else np.zeros(0, dtype=np.uint64)
                edge = np.arange(len(codes)) - starts == n - 1
                grams = np.concatenate([pairs, h[keep & edge]])
            else:
                grams = h[keep]
            g, counts = np.unique(grams, return_counts=True)
            if n == 1:
                out[n] = (g, np.zeros(1, dtype=np.uint64), np.zeros(len(g), dtype=np.int64), counts.astype(float))
                continue
            prev = by[n - 1][0]
            at = np.flatnonzero(keep)
            gg, first = np.unique(h[at], return_index=True)
            ctx = prev[at[first] - 1]
            ctx_of_g = ctx[np.searchsorted(gg, g)]
            c, ctx_of = np.unique(ctx_of_g, return_inverse=True)
            out[n] = (g, c, ctx_of, counts.astype(float))
        return out

    def logs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The log-probability of each character of ``_word_`` under each language, and where words begin."""
        codes, starts, begin = _spell(words)
        p = np.full((len(codes), len(self.languages)), self.floor)
        prev = None
        for n, h, ok in _hash_steps(codes, starts, self.order):
            gh, gv = self.grams[n - 1]
            ch, cv = self.contexts[n - 1]
            g = np.minimum(np.searchsorted(gh, h), len(gh) - 1)
            hit = (gh[g] == h) & ok
            if n == 1:
                p *= cv[0]
            else:
                ctx = np.concatenate([[np.uint64(0)], prev[:-1]])
                c = np.minimum(np.searchsorted(ch, ctx), len(ch) - 1)
                known = (ch[c] == ctx) & ok
                p[known] *= cv[c[known]]
            p[hit] += gv[g[hit]]
            prev = h
        out = np.log(p)
        out[begin] = 0  # the first mark is given
        return out, begin

    def score(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word under each language; 0 for an empty word."""
        if not words:
            return np.zeros((0, len(self.languages)))
        logs, begin = self.logs(words)
        out = np.add.reduceat(logs, begin, axis=0)
        out[[i for i, w in enumerate(words) if not w]] = 0
        return out


def letters_of(token: str) -> str:
    """The lower-case letters of a token."""
    return "".join(_LETTERS.findall(token)).lower()


def _ends(token: str) -> bool:
    """A mark of punctuation ends the token."""
    return not (token[-1].isalnum() or token[-1] in "'’-")


class Identifier:
    """Models with calibration, and a bounded memory of scored tokens."""

    def __init__(self, samples: dict[str, list[str]], order: int = ORDER):
        held, rest = {}, {}
        for lang, texts in samples.items():
            held[lang] = [t for i, t in enumerate(texts) if i % 5 == 0]
            rest[lang] = [t for i, t in enumerate(texts) if i % 5] or texts
        self.models = Models(rest, order)
        self.temperatures, self.limits = self._calibrate(held)
        self.models = Models(samples, order)
        self.forget()

    def forget(self) -> None:
        self._ids: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.languages)))
        self.sizes = np.zeros(0)  # letters and one boundary, 0 for a token without letters
        self.marks = np.zeros((0, 2), dtype=bool)  # a mark begins, ends the token

    @property
    def languages(self) -> list[str]:
        return self.models.languages

    def _calibrate(self, held: dict[str, list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The temperature with the best held-out likelihood, and the limit of rejection: halfway between the worst
        entropy of held-out sentences under their own language and that of random letters.

        At n below :data:`RUN` both are those of n words in a row, at :data:`RUN` those of whole sentences.
        """
        mean, truth = [[] for _ in range(RUN + 1)], [[] for _ in range(RUN + 1)]
        for k, lang in enumerate(self.languages):
            for t in held[lang]:
                w = [x for x in map(letters_of, clean(t).split()) if x]
                if w:
                    score, size = self.models.score(w), np.array([len(x) + 1 for x in w])
                    for n in range(1, RUN + 1):
                        spans = [(0, len(w))] if n == RUN else [(i, i + n) for i in range(0, len(w) - n + 1, n)]
                        mean[n] += [score[a:b].sum(axis=0) / size[a:b].sum() for a, b in spans]
                        truth[n] += [k] * len(spans)
        temperatures, limits = np.ones(RUN + 1), np.full(RUN + 1, np.inf)
        for n in range(1, RUN + 1):
            if not mean[n] or len(self.languages) < 2:
                continue
            m, y = np.array(mean[n]), np.array(truth[n])
            best = (np.inf, 1.0)
            for temp in np.geomspace(0.05, 2, 40):
                z = m / temp
                z = z - z.max(axis=1, keepdims=True)
                nll = -(z[np.arange(len(y)), y] - np.log(np.exp(z).sum(axis=1))).mean()
                best = min(best, (nll, temp))
            own = -m[np.arange(len(y)), y]
            temperatures[n], limits[n] = best[1], (own.max() - np.log(self.models.floor)) / 2
        return temperatures, limits

    def token_ids(self, tokens: list[str]) -> np.ndarray:
        """Rows of ``scores``, ``sizes`` and ``marks``; new tokens are scored together."""
        if len(self._ids) > 400_000:
            self.forget()
        ids = self._ids
        new = [t for t in set(tokens) if t not in ids]
        if new:
            words = [letters_of(t) for t in new]
            distinct = list(dict.fromkeys(words))
            row = {w: i for i, w in enumerate(distinct)}
            self.scores = np.concatenate([self.scores, self.models.score(distinct)[[row[w] for w in words]]])
            self.sizes = np.concatenate([self.sizes, [len(w) + 1.0 if w else 0.0 for w in words]])
            self.marks = np.concatenate([self.marks, [(not t[0].isalnum(), _ends(t)) for t in new]])
            for t in new:
                ids[t] = len(ids)
        return np.fromiter(map(ids.__getitem__, tokens), dtype=np.int64, count=len(tokens))

    def against(self, text: str, lang: str) -> float:
        """Nats by which a text speaks for its likeliest language rather than for ``lang``; 0 if it has no words."""
        words = clean(text).split()
        if not words or lang not in self.languages:
            return 0.0
        ids = self.token_ids(words)
        total = self.scores[ids].sum(axis=0)
        return float(total.max() - total[self.languages.index(lang)])

    def _paths(self, scores: np.ndarray, marks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The cheapest language of each word of each text: Viterbi over ``[texts, words, languages]`` at once."""
        t, w, k = scores.shape
        best = scores[:, 0].copy()
        back = np.zeros((w, t, k), dtype=np.int8)
        every, langs = np.arange(t), np.arange(k, dtype=np.int8)
        for i in range(1, w):
            top = best.argmax(axis=1)
            jump = (best[every, top] - np.where(marks[:, i - 1], SWITCH_AT_MARK, SWITCH))[:, None]
            stay = best >= jump
            back[i] = np.where(stay, langs, top[:, None])
            best = np.where(stay, best, jump) + scores[:, i]  # scores are 0 beyond a text's end
        out = np.zeros((t, w), dtype=np.int8)
        state = best.argmax(axis=1)
        for i in range(w - 1, -1, -1):
            out[:, i] = state
            state = back[i][every, state]
        return out

    def segments(self, texts: list[str | None], least: int = RUN) -> list[list[tuple[int, int, str, float]]]:
        """For each text its runs ``(first word, last word + 1, language, confidence)``.

        Runs of fewer than :data:`RUN` words with letters join a neighbour; a text of one language, or of
        fewer than :data:`RUN` words, is one run.  NULL and texts of fewer than ``least`` words give none.
        """
        out: list[list] = [[] for _ in texts]
        parts: list[tuple[int, list[str]]] = []
        for n, t in enumerate(texts):
            if t:
                w = t.split() if t.isascii() else clean(t).split()
                if len(w) >= max(least, 1):
                    parts.append((n, w))
        parts.sort(key=lambda p: len(p[1]))
        i = 0
        while i < len(parts):
            j, first = i, len(parts[i][1])
            while j < len(parts) and j < i + 4_000 and len(parts[j][1]) <= 8 + first * 5 // 4 and (j + 1 - i) * len(parts[j][1]) <= 200_000 or j == i:
                j += 1
            self._batch(parts[i:j], out)
            i = j
        return out

    def _batch(self, parts: list, out: list[list]) -> None:
        lengths = np.array([len(p[1]) for p in parts])
        width = int(lengths.max())
        ids = self.token_ids([w for p in parts for w in p[1]])
        rows = np.repeat(np.arange(len(parts)), lengths)
        cols = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        scores = np.zeros((len(parts), width, len(self.languages)))
        scores[rows, cols] = self.scores[ids]
        marks = np.zeros((len(parts), width), dtype=bool)
        marks[rows, cols] = self.marks[ids, 1]
        opens = np.flatnonzero(self.marks[ids, 0] & (cols > 0))
        marks[rows[opens], cols[opens] - 1] = True
        sizes = np.zeros((len(parts), width))
        sizes[rows, cols] = self.sizes[ids]
        paths = self._paths(scores, marks, lengths)
        changes = np.zeros((len(parts), width), dtype=bool)
        changes[:, 1:] = (paths[:, 1:] != paths[:, :-1]) & (np.arange(1, width) < lengths[:, None])
        few = lengths < RUN
        changes[few] = False
        one = ~changes.any(axis=1)
        total = scores.sum(axis=1)
        langs, confs = self._judge(total, sizes.sum(axis=1), np.where(few, total.argmax(axis=1), paths[:, 0]), np.where(few, (sizes > 0).sum(axis=1), RUN))
        for r, (n, words) in enumerate(parts):
            if one[r]:
                out[n].append((0, len(words), langs[r], confs[r]))
            else:
                runs = self._runs(paths[r, : len(words)], np.flatnonzero(changes[r]).tolist(), scores[r], sizes[r])
                total = np.array([scores[r, a:b].sum(axis=0) for a, b, _ in runs])
                size = np.array([sizes[r, a:b].sum() for a, b, _ in runs])
                for (a, b, _), lang, conf in zip(runs, *self._judge(total, size, np.array([k for _, _, k in runs]))):
                    out[n].append((a, b, lang, conf))

    def _judge(self, total: np.ndarray, size: np.ndarray, chosen: np.ndarray, words: np.ndarray | int = RUN) -> tuple[list[str], list[float]]:
        """Language and confidence from summed log-probabilities and sizes; ``words`` chooses the calibration."""
        mean = total / np.maximum(size, 1)[:, None]
        own = mean[np.arange(len(mean)), chosen]
        conf = 1.0 / np.exp((mean - own[:, None]) / np.broadcast_to(self.temperatures[words], len(mean))[:, None]).sum(axis=1)
        known = (size > 0) & (-own <= self.limits[words])
        return [self.languages[k] if ok else UNDETERMINED for k, ok in zip(chosen.tolist(), known.tolist())], np.where(size > 0, conf, 0.0).tolist()

    def _runs(self, path: np.ndarray, cuts: list[int], scores: np.ndarray, sizes: np.ndarray) -> list[list[int]]:
        """``[first word, last word + 1, language]`` of the runs of a path, those of too few words given to a neighbour.

        The shortest run goes first, to the neighbour whose language suits it better; neighbours of one
        language that then meet are one run.  A linked list and a heap, so the order of n runs costs n log n.
        """
        begin, end = [0, *cuts], [*cuts, len(path)]
        lang = [int(path[a]) for a in begin]
        filled = np.concatenate([[0], np.cumsum(sizes[: len(path)] > 0)])
        words = [int(filled[b] - filled[a]) for a, b in zip(begin, end)]
        before, after = list(range(-1, len(begin) - 1)), [*range(1, len(begin)), -1]
        alive = [True] * len(begin)
        heap = [(w, a, q) for q, (w, a) in enumerate(zip(words, begin)) if w < RUN]
        heapq.heapify(heap)

        def join(q: int, to: int) -> None:
            """Make ``q`` part of its neighbour ``to``."""
            alive[q] = False
            begin[to], end[to], words[to] = min(begin[to], begin[q]), max(end[to], end[q]), words[to] + words[q]
            if before[q] >= 0:
                after[before[q]] = after[q]
            if after[q] >= 0:
                before[after[q]] = before[q]

        left = len(begin)
        while heap and left > 1:
            n, a, q = heapq.heappop(heap)
            if not alive[q] or n != words[q] or a != begin[q]:
                continue  # it has changed since
            near = [x for x in (before[q], after[q]) if x >= 0]
            to = max(near, key=lambda x: scores[a : end[q], lang[x]].sum())
            join(q, to)
            left -= 1
            for x in (before[to], after[to]):
                if x >= 0 and lang[x] == lang[to]:
                    join(x, to)
                    left -= 1
            if words[to] < RUN:
                heapq.heappush(heap, (words[to], begin[to], to))
        return sorted([begin[q], end[q], lang[q]] for q in range(len(alive)) if alive[q])


# ---- distribution ---------------------------------------------------------------------------------------------------

_ready: dict[str, Identifier] = {}


def load_samples(df: DataFrame, key: str = "sample_id", lang: str = "lang", text: str = "sample_text", bound: int = SAMPLES) -> dict[str, list[str]]:
    """Up to ``bound`` sentences of each language by smallest key, for the driver to fit the models on."""
    w = Window.partitionBy(lang).orderBy(key)
    rows = df.where(f"{text} IS NOT NULL AND {lang} IS NOT NULL").withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= bound).select(lang, text, "__k").collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r[0], r["__k"])):
        out.setdefault(r[0], []).append(r[1])
    return out


def identifier(samples: dict[str, list[str]]) -> Identifier:
    """The identifier fitted on ``samples``, made once a process: what is sent to tasks is the bounded sample."""
    key = str(hash(tuple((k, tuple(v)) for k, v in sorted(samples.items()))))
    if key not in _ready:
        _ready[key] = Identifier(samples)
    return _ready[key]


def segments(df: DataFrame, key: str, fields: dict[str, str], samples: dict[str, list[str]], cases_only: bool = False, least: int = RUN) -> DataFrame:
    """``key, field_name, seg_no, lang, confidence`` (and ``label`` unless ``cases_only``) of each text of ``least`` or more words.

    ``fields`` maps text columns to their label columns.  A text of several languages gives one row for
    each run, numbered in text order; with ``cases_only``, texts of one language only where their label is
    missing or wrong, and nothing that is rejected, but with the same numbers.  Narrow: one pass, no shuffle.
    """
    schema = pa.schema([(key, pa.int64()), ("field_name", pa.string()), ("seg_no", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64())] + ([] if cases_only else [("label", pa.string())]))

    def run(batches):
        ident = identifier(samples)
        for b in batches:
            keys = b.column(0).to_pylist()
            out: list[tuple] = []
            for field, lab in fields.items():
                labels = b.column(lab).to_pylist()
                for k, said, segs in zip(keys, labels, ident.segments(b.column(field).to_pylist(), least)):
                    if not segs:
                        continue
                    runs = [(n, lang, conf) for n, (_, _, lang, conf) in enumerate(segs)]
                    if cases_only:
                        runs = [r for r in runs if r[1] != UNDETERMINED]
                        if len({r[1] for r in runs}) == 1:  # a text of one language, whatever was rejected beside it
                            runs = [] if label(said) == runs[0][1] else [(0, *max(runs, key=lambda r: r[2])[1:])]
                    out += [(k, field, *r) if cases_only else (k, field, *r, label(said)) for r in runs]
            cols = list(zip(*out)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    ddl = f"{key} bigint, field_name string, seg_no int, lang string, confidence double" + ("" if cases_only else ", label string")
    return spread(df.select(F.col(key).cast("bigint").alias(key), *dict.fromkeys([*fields, *fields.values()]))).mapInArrow(run, ddl)

