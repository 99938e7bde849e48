"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import lean, load, pieces
from pairloom.llm.pii_examples import expanded

KINDS = ("email", "ip", "card", "phone", "secret")
TAGS = ("O", *KINDS)

# Fixed patterns, as the results must agree with them.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SIGNAL = re.compile(r"[0-9@]")
WORD = re.compile(r"\S+")
TRIM = ".,;:!?\"'()[]<>"
SYMBOLS = 100_000
PART = 20_000
PAD = 1_000

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each pattern that do not overlap; those that fail their check are dropped.

    A pattern can only match where the text has a digit or an at sign, so texts without are not searched, and
    addresses are looked for around at signs and phones from plus signs on, which gives the same matches.
    """
    found: list[Span] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email") for m in emails(text)]
    if not SIGNAL.search(text):
        return found
    for m in IP_RUNS.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


LOCAL = re.compile(r"[A-Za-z0-9._%+-]")

#: Matches as IP does, in linear time: a match begins and ends with whole runs of digits, so no search starts inside one.
IP_RUNS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")


def emails(text: str) -> Iterator[re.Match]:
    """Matches of EMAIL from left to right.

    A match starts with the run of local characters before an at sign, cut off at the end of the match
    before; so the search can start there, and long runs without an at sign cost nothing.
    """
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m
            done = m.end()
        at = text.find("@", max(at + 1, done))


def shape(word: str) -> str:
    """The word with letters, capitals and digits made alike, runs cut to three."""
    out = []
    for c in word:
        k = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if out[-3:] != [k] * 3:
            out.append(k)
    return "".join(out)


def features(word: str) -> list[str]:
    """What the tagger sees of a word: its shape in full and in brief, its ends, its length and its mixture."""
    bare = word.strip(TRIM)
    full = shape(bare)
    brief = re.sub(r"(.)\1+", r"\1", full)
    digits = sum(c.isdigit() for c in bare)
    letters = sum(c.isalpha() for c in bare)
    listed = [f"shape={full}", f"brief={brief}", f"start={full[:2]}", f"end={full[-2:]}"]
    listed.append(f"digits={min(digits, 20) if digits < 6 else 6 + (digits - 6) // 3}")
    listed.append(f"length={min(len(bare), 60) // 4}")
    listed.append(f"mixed={digits > 0}{letters > 0}{'@' in bare}{bare[:1] == '+'}{bare.count('.') == 3}{'=' in bare}")
    if digits >= 6 and letters >= 4 and bare.isalnum():
        listed.append("code")
    if not digits and len(bare) <= 9:
        listed.append(f"word={bare.lower()}")
    return listed


class Tagger:
    """Weights of a chain: of features of a word and of its neighbours per tag, and of one tag after another."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, follow: np.ndarray):
        self.names, self.weights, self.follow = names, weights, follow
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.symbols: dict[str, int] = {}
        self.rows: list[np.ndarray] = []
        self.filled, self.table = 0, np.zeros((1024, 3, len(TAGS)))

    def scores(self) -> np.ndarray:
        """Scores of all feature sets met so far, as (set, place beside the word, tag)."""
        n = len(self.rows)
        if n > len(self.table):
            self.table = np.concatenate((self.table, np.zeros((n, 3, len(TAGS)))))
        if self.filled < n:
            self.table[self.filled : n] = self.rows[self.filled :]
            self.filled = n
        return self.table

    def symbol(self, word: str) -> int:
        """Number of the word's feature set; words of equal features share it."""
        number = self.words.get(word)
        if number is None:
            like = self.plain(word)
            number = self.words.get(like) if like is not word else None
            if number is not None:
                self.words[word] = number
                return number
            key = "\0".join(f for f in features(like) if f in self.names)
            number = self.symbols.get(key)
            if number is None:
                number = self.symbols[key] = len(self.symbols)
                ids = [self.names[f] for f in key.split("\0") if f]
                self.rows.append(self.weights[:, ids].sum(axis=1))
            self.words[word] = self.words[like] = number
        return number

    def plain(self, word: str) -> str:
        """For words of small letters, but for a capital in front, that are not in the table: one of the same features."""
        bare = word.strip(TRIM)
        if bare.isalpha() and (bare.islower() or bare[0].isupper() and bare[1:].islower()) and f"word={bare.lower()}" not in self.names:
            return ("Q" if bare[0].isupper() else "q") + "q" * (len(bare) - 1)
        return word

    def emissions(self, lines: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Scores (line, place, tag) of words within their context, and the lines' lengths.

        Words met before are kept, up to a bound.
        """
        if len(self.words) > SYMBOLS:
            self.forget()
        numbers = [[self.symbol(w) for w in words] for words in lines]
        scores = self.scores()
        rows = []
        for number in numbers:
            score = scores[number]
            total = score[:, 1].copy()
            total[1:] += score[:-1, 0]
            total[:-1] += score[1:, 2]
            rows.append(total)
        sizes = np.array([len(r) for r in rows])
        padded = np.zeros((len(rows), int(sizes.max()), len(TAGS)))
        for i, r in enumerate(rows):
            padded[i, : len(r)] = r
        return padded, sizes

    def may_have_spans(self, lines: list[list[str]]) -> np.ndarray:
        """False for lines (of one word or more) whose best sequence surely has no tag.

        Each word of a run of tagged words adds what its tag scores above none and up to two steps between tags; if
        that is negative for all words of a line, no run can pay.
        """
        if len(self.words) > SYMBOLS:
            self.forget()
        flat = np.array([self.symbol(w) for words in lines for w in words])
        firsts = np.cumsum([0, *map(len, lines[:-1])])
        scores = self.scores()
        total = scores[flat, 1]
        before, after = scores[flat[:-1], 0], scores[flat[1:], 2]
        before[firsts[1:] - 1] = 0
        after[firsts[1:] - 1] = 0
        total[1:] += before
        total[:-1] += after
        gain = (total[:, 1:] - total[:, :1]).max(axis=1) + 2 * max(0.0, float((self.follow - self.follow[0, 0]).max()))
        return np.maximum.reduceat(gain, firsts) >= 0

    def decode(self, lines: list[list[str]]) -> list[np.ndarray]:
        """Best tag sequence of every line, by Viterbi over all lines of the batch at once."""
        score, sizes = self.emissions(lines)
        n, steps, tags = score.shape
        best = score[:, 0]
        back = np.zeros((steps, n, tags), np.int64)
        for t in range(1, steps):
            through = best[:, :, None] + self.follow[None]
            back[t] = through.argmax(axis=1)
            best = np.where((t < sizes)[:, None], through.max(axis=1) + score[:, t], best)
        tag = best.argmax(axis=1)
        paths = np.zeros((n, steps), np.int64)
        for t in range(steps - 1, -1, -1):
            paths[:, t] = tag
            tag = np.where(t < sizes, back[t][np.arange(n), tag], tag)
        return [p[:s] for p, s in zip(paths, sizes, strict=True)]


def fit_tagger(table: list[tuple[str, list[Span]]], rounds: int = 150, decay: float = 1e-3) -> Tagger:
    """Maximise the conditional likelihood of a labelled table, by gradients from forward and backward sums."""
    words = [[m for m in WORD.finditer(line)] for line, _ in table]
    gold = [
        [next((TAGS.index(k) for a, b, k in spans if m.start() < b and m.end() > a), 0) for m in ms]
        for ms, (_, spans) in zip(words, table, strict=True)
    ]
    listed = [[features(m[0]) for m in ms] for ms in words]
    names = {f: i for i, f in enumerate(sorted({f for line in listed for w in line for f in w}))}
    steps = max(map(len, words))
    n, width, tags = len(table), len(names), len(TAGS)
    x = np.zeros((n, steps + 2, width))
    y = np.zeros((n, steps, tags))
    mask = np.zeros((n, steps))
    for i, line in enumerate(listed):
        for t, fs in enumerate(line):
            x[i, t + 1, [names[f] for f in fs]] = 1
            y[i, t, gold[i][t]] = 1
            mask[i, t] = 1
    around = [x[:, :-2], x[:, 1:-1], x[:, 2:]]
    weights, follow = np.zeros((3, width, tags)), np.zeros((tags, tags))
    squares = [np.full_like(weights, 1e-6), np.full_like(follow, 1e-6)]
    for _ in range(rounds):
        score = sum(a @ w for a, w in zip(around, weights, strict=True))
        ahead = np.zeros((n, steps, tags))
        after = np.zeros((n, steps, tags))
        ahead[:, 0] = score[:, 0]
        for t in range(1, steps):
            new = np.logaddexp.reduce(ahead[:, t - 1, :, None] + follow, axis=1) + score[:, t]
            ahead[:, t] = np.where(mask[:, t, None] > 0, new, ahead[:, t - 1])
        for t in range(steps - 2, -1, -1):
            new = np.logaddexp.reduce(follow + (score[:, t + 1] + after[:, t + 1])[:, None, :], axis=2)
            after[:, t] = np.where(mask[:, t + 1, None] > 0, new, 0)
        z = np.logaddexp.reduce(ahead[:, -1], axis=1)
        node = np.exp(ahead + after - z[:, None, None]) * mask[:, :, None]
        edge = np.exp(
            ahead[:, :-1, :, None] + follow + (score[:, 1:] + after[:, 1:])[:, :, None, :] - z[:, None, None, None]
        )
        edge *= mask[:, 1:, None, None]
        d = y - node
        g_weights = np.stack([np.einsum("ntf,ntk->fk", a, d) for a in around]) - decay * n * weights
        g_follow = np.einsum("ntj,ntk->jk", y[:, :-1], y[:, 1:] * mask[:, 1:, None]) - edge.sum(axis=(0, 1)) - decay * n * follow
        for value, gradient, square in ((weights, g_weights, squares[0]), (follow, g_follow, squares[1])):
            square += gradient**2
            value += 0.5 * gradient / np.sqrt(square)
    return Tagger(names, weights, follow)


def tagged_spans(lines: list[str], tagger: Tagger) -> list[list[Span]]:
    """Spans that the tagger finds in each line: runs of one tag, without outer punctuation and keywords."""
    words = [[(m.start(), m[0]) for m in WORD.finditer(line)] for line in lines]
    result = []
    paths = tagger.decode([[w for _, w in line] for line in words])
    for line, path, text in zip(words, paths, lines, strict=True):
        spans: list[Span] = []
        for (start, word), tag in zip(line, path.tolist(), strict=True):
            if not tag:
                continue
            kind, end = TAGS[tag], start + len(word)
            if spans and spans[-1][2] == kind and text[spans[-1][1] : start].isspace():
                spans[-1] = (spans[-1][0], end, kind)
            else:
                spans.append((start, end, kind))
        result.append([s for s in (trimmed(text, s) for s in spans) if s])
    return result


def trimmed(text: str, span: Span) -> Span | None:
    start, end, kind = span
    if kind == "secret":
        cut = max(text.rfind("=", start, end), text.rfind('"', start, end - 1))
        start = cut + 1 if cut >= start else start
    while start < end and text[start] in TRIM and not (kind == "phone" and text[start] == "("):
        start += 1
    while end > start and text[end - 1] in TRIM:
        end -= 1
    return (start, end, kind) if any(c.isdigit() or c == "@" for c in text[start:end]) or kind == "email" and start < end else None


def widened(text: str, first: int, start: int, end: int, last: int) -> tuple[int, str]:
    """The part of a line from first to last with PAD characters on both sides, up to a space: where it starts, and the part."""
    low = text.find(" ", max(first, start - PAD), start) if start > first else start
    low = start if low < 0 else low
    high = text.find(" ", end + PAD, last) if end < last else end
    high = last if high < 0 else high
    return low, text[low:high]


def merged(spans: list[Span]) -> list[Span]:
    """Spans in order, those of one kind that overlap as one."""
    out: list[Span] = []
    for start, end, kind in sorted(spans):
        if out and out[-1][2] == kind and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]), kind)
        else:
            out.append((start, end, kind))
    return out


def find_spans(texts: list[str], tagger: Tagger, batch: int = 512) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of every text.

    The tagger reads every line; very long lines are read in parts that end at spaces and overlap by PAD characters
    on both sides. An added span that overlaps a base span is dropped.
    """
    base = [base_spans(t) if t else [] for t in texts]
    added: list[list[Span]] = [[] for _ in texts]
    waiting: list[tuple[int, int, str, int, int]] = []
    for number, text in enumerate(texts):
        start = 0
        while text and start < len(text):
            end = text.find("\n", start)
            end = len(text) if end < 0 else end
            first = start
            while end - start > PART:
                cut = text.find(" ", start + PART // 2, end)
                if cut < 0:
                    break
                waiting.append((number, *widened(text, first, start, cut, end), start, cut))
                start = cut
            waiting.append((number, *widened(text, first, start, end, end), start, end))
            start = end + 1
    split = [w[2].split() for w in waiting]
    waiting = [w for w, words in zip(waiting, split, strict=True) if words]
    split = [words for words in split if words]
    if waiting:
        waiting = [w for w, some in zip(waiting, tagger.may_have_spans(split), strict=True) if some]
    waiting.sort(key=lambda w: len(w[2]))
    for a in range(0, len(waiting), batch):
        some = waiting[a : a + batch]
        for (number, at, _, start, end), spans in zip(some, tagged_spans([w[2] for w in some], tagger), strict=True):
            added[number] += [(at + x, at + y, k) for x, y, k in spans if at + x < end and at + y > start]
    for number, spans in enumerate(added):
        known = base[number]
        added[number] = [s for s in merged(spans) if all(s[1] <= b[0] or s[0] >= b[1] for b in known)]
    return list(zip(base, added, strict=True))


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))
    return ",".join(f"{k}:{a}:{b}" for a, b, k in ordered)


PII_SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)


def personal_data(docs: DataFrame, table: list[tuple[str, list[Span]]] | None = None, id_column: str = "doc_id") -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans.

    Null texts count as empty and have no spans; a row depends on its text alone, so repeated rows are alike;
    other columns are not read.
    """
    tagger = fit_tagger(table or expanded())
    model = (tagger.names, tagger.weights, tagger.follow)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, follow = shipped.value
        known = Tagger(names, weights, follow)
        for piece in pieces(batches):
            rows = []
            for base, added in find_spans(piece.column("text").to_pylist(), known):
                counts = [sum(k == kind for _, _, k in base) for kind in KINDS[:4]]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*counts, digest, joined(base + added), len(added)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            cols = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column(0), *cols], names=[c.split()[0] for c in PII_SCHEMA.split(", ")])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), "text").mapInArrow(lean(scan), PII_SCHEMA)


def op6_word_shape_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(load(spark, sf_dir, "documents"))
