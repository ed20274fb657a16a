"""Personal data by fixed patterns and a linear-chain conditional random field.

The patterns find e-mail addresses, IP addresses, card and phone numbers. The field is trained on a
small labelled table: windows of words around the patterns' finds, and around other words with
digits, in a bounded sample of documents. Beside each window stand others in which its finds are
written as people write them and the patterns miss them (``variants``): phone numbers without a
plus, with dots, or right before another number, shorter card numbers. The field tags words by their
shape and their neighbours' shapes, so it finds such spans too. What it adds must still read as its
kind (``plausible``); a tagged stretch is cut where a pattern's find begins or ends.

Words without a digit and without ``@`` are outside by definition of the model, so the best path
falls apart into short runs of other words; runs of equal length are decoded together by Viterbi.

Defined results: null text is the empty text; an empty table stays empty; without any labelled
window nothing is added; repeated rows are searched each.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Documents looked at for labelled windows, windows of each and words on each side of a find.
SAMPLE_DOCUMENTS = 2000
WINDOWS_EACH = 6
VARIANTS_EACH = 2
AROUND = 4
STEPS = 150
RATE = 0.15
PENALTY = 1e-3

TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive runs that begin where a run of digits begins: same finds, linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Addresses, found from their @: the name before it reaches back as far as it can."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        match = _DOMAIN.match(text, at) if begin < at else None
        if match:
            found.append((begin, match.end()))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    return found


def octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def phones(text: str) -> list[tuple[int, int]]:
    """Numbers from a plus on; a match ends with the last digit of its run."""
    found, at = [], text.find("+")
    while at >= 0:
        match = _PHONE.match(text, at)
        end = match.end() if match else at
        while end > at and not "0" <= text[end - 1] <= "9":
            end -= 1
        if end - at >= 4:
            if 8 <= sum("0" <= c <= "9" for c in text[at:end]) <= 15:
                found.append((at, end))
            at = text.find("+", end)
        else:
            at = text.find("+", at + 1)
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns' finds, by kind, then start."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    if _MARK.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if octets(m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *s) for s in phones(text)]
    return out


def shape(word: str) -> str:
    """Runs of capitals, other letters and digits as A, a and 9; other signs stay."""
    mapped = re.sub("[0-9]+", "9", word)
    mapped = re.sub("[A-Z]+", "A", mapped)
    return re.sub("[^A0-9!-/:-@\\[-`{-~]+", "a", mapped)[:16]


def features(word: str) -> list[str]:
    """Own features of a word with a digit or an @."""
    own = re.sub("[^0-9]", "", word)
    digits = len(own)
    return ["bias", "s=" + shape(word), f"digits={min(digits, 20)}", f"at={'@' in word}",
            f"luhn={13 <= digits <= 19 and luhn(own)}",
            f"dots={min(word.count('.'), 4)}", f"first={shape(word[:1])}",
            f"letters={any(c.isalpha() for c in word)}", f"length={min(len(word) // 4, 6)}"]


def beside(word: str | None) -> str:
    """What a neighbour sees of a word."""
    return "plain" if word is None or not _MARK.search(word) else shape(word)[:8]


class ChainField:
    """Weights of a linear-chain conditional random field over TAGS."""

    def __init__(self):
        self.own: dict[str, int] = {}
        self.near: dict[str, int] = {}
        self.weights = [np.zeros((0, len(TAGS)))] * 3
        self.moves = np.zeros((len(TAGS), len(TAGS)))
        self._scores: dict[str, np.ndarray] = {}

    def train(self, rows: list[tuple[list[str], list[int]]]) -> ChainField:
        """Maximises the penalised likelihood by Adagrad over all windows at once."""
        if not rows:
            return self
        size, n_tags = max(len(words) for words, _ in rows), len(TAGS)
        tags = np.zeros((len(rows), size), np.int64)
        free = np.zeros((len(rows), size), bool)
        cells: list[list[tuple[int, int]]] = [[], [], []]
        for r, (words, gold) in enumerate(rows):
            for i, word in enumerate(words):
                if not _MARK.search(word):
                    continue
                free[r, i], tags[r, i] = True, gold[i]
                cell = r * size + i
                cells[0] += [(cell, self.own.setdefault(f, len(self.own)))
                             for f in features(word)]
                for k, j in ((1, i - 1), (2, i + 1)):
                    other = beside(words[j] if 0 <= j < len(words) else None)
                    cells[k].append((cell, self.near.setdefault(other, len(self.near))))
        cells = [np.array(c, np.int64).reshape(-1, 2) for c in cells]
        counts = (len(self.own), len(self.near), len(self.near))
        self.weights = [np.zeros((n, n_tags)) for n in counts]
        steps = [np.full_like(w, 1e-8) for w in (*self.weights, self.moves)]
        gold = np.eye(n_tags)[tags] * free[..., None]
        gold_moves = np.zeros((n_tags, n_tags))
        np.add.at(gold_moves, (tags[:, :-1], tags[:, 1:]), 1)
        shut = np.full(n_tags, -1e9)
        shut[0] = 0
        for _ in range(STEPS):
            score = np.zeros((tags.size, n_tags))
            for c, w in zip(cells, self.weights):
                for t in range(n_tags):
                    score[:, t] += np.bincount(c[:, 0], w[c[:, 1], t], tags.size)
            score = np.where(free[..., None], score.reshape(*tags.shape, n_tags), shut)
            forward, backward = np.zeros_like(score), np.zeros_like(score)
            forward[:, 0] = score[:, 0]
            for i in range(1, size):
                forward[:, i] = score[:, i] + _logsum(
                    forward[:, i - 1, :, None] + self.moves, 1)
            for i in range(size - 2, -1, -1):
                backward[:, i] = _logsum(
                    self.moves + (score[:, i + 1] + backward[:, i + 1])[:, None, :], 2)
            total = _logsum(forward[:, -1], 1)
            share = np.exp(forward + backward - total[:, None, None])
            moved = np.exp(forward[:, :-1, :, None] + self.moves
                           + (score[:, 1:] + backward[:, 1:])[:, :, None, :]
                           - total[:, None, None, None]).sum((0, 1))
            slack = (gold - share * free[..., None]).reshape(-1, n_tags)
            up = [np.stack([np.bincount(c[:, 1], slack[c[:, 0], t], len(w))
                            for t in range(n_tags)], 1) - PENALTY * len(rows) * w
                  for c, w in zip(cells, self.weights)]
            up.append(gold_moves - moved - PENALTY * len(rows) * self.moves)
            for w, g, s in zip((*self.weights, self.moves), up, steps):
                s += g * g
                w += RATE * g / np.sqrt(s)
        return self

    def _own(self, word: str) -> np.ndarray:
        known = self._scores.get(word)
        if known is None:
            if len(self._scores) > 200_000:
                self._scores.clear()
            at = [self.own[f] for f in features(word) if f in self.own]
            known = self._scores[word] = self.weights[0][at].sum(0)
        return known

    def _beside(self, k: int, word: str | None) -> np.ndarray | float:
        at = self.near.get(beside(word))
        return 0.0 if at is None else self.weights[k][at]

    def decode(self, runs: list[list[str]]) -> list[np.ndarray]:
        """Best tags of runs of marked words, each between plain words."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(runs)
        by_size: dict[int, list[int]] = {}
        for r, words in enumerate(runs):
            by_size.setdefault(len(words), []).append(r)
        for size, members in by_size.items():
            score = np.stack([np.stack([
                self._own(w) + self._beside(1, runs[r][i - 1] if i else None)
                + self._beside(2, runs[r][i + 1] if i + 1 < size else None)
                for i, w in enumerate(runs[r])]) for r in members])
            best, back = self.moves[0] + score[:, 0], []
            for i in range(1, size):
                steps = best[:, :, None] + self.moves
                back.append(steps.argmax(1))
                best = steps.max(1) + score[:, i]
            tag = (best + self.moves[:, 0]).argmax(1)
            path = [tag]
            for b in reversed(back):
                tag = b[np.arange(len(members)), tag]
                path.append(tag)
            for r, tags in zip(members, np.stack(path[::-1], 1)):
                out[r] = tags
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def marked_runs(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring words with a digit or @, as (start, end)."""
    runs, last = [], -2
    for i, m in enumerate(_WORD.finditer(text)):
        if _MARK.search(m.group()):
            if i == last + 1:
                runs[-1].append(m.span())
            else:
                runs.append([m.span()])
            last = i
    return runs


def plausible(kind: str, found: str) -> bool:
    """Whether a tagged stretch can be what its tag says."""
    digits = re.sub("[^0-9]", "", found)
    if kind == "email":
        return re.fullmatch(r"[^@\s]+@[^@\s]*[A-Za-z0-9]", found) is not None
    if kind == "ip":
        parts = found.split(".")
        return len(parts) == 4 and all(p.isdigit() for p in parts) and octets(parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9\x20-]", found)
    return 7 <= len(digits) <= 15 and re.search(r"[^0-9+().\x20/-]", found) is None


def with_check_digit(digits: str) -> str:
    """The digits with a last one that makes them pass Luhn."""
    return next(digits + d for d in "0123456789" if luhn(digits + d))


def variants(words: list[str], tags: list[str], draw: int):
    """The window with its phone and card numbers written otherwise, by the drawn number.

    None of these is a find of the patterns as a whole.
    """
    finds, i = [], 0
    while i < len(words):
        j = i + 1
        if tags[i][:2] == "B-":
            while j < len(words) and tags[j][:2] == "I-":
                j += 1
            finds.append((tags[i][2:], i, j))
        i = j
    for kind, i, j in finds:
        digits = re.sub("[^0-9]", "", "".join(words[i:j]))
        own = digits[-10:] if len(digits) >= 10 else digits.rjust(10, "2")
        a, b, c = own[:3], own[3:6], own[6:]
        after, after_tags = [], []
        if kind == "phone":
            written = ([f"({a})", f"{b}-{c}"], [f"{a}.{b}.{c}"], [f"{a}-{b}-{c}"],
                       [a, b, c], [f"({a}){b}-{c}"], words[i:j], words[i:j], ["+1", f"({a})",
                       f"{b}-{c}"])[draw % 8]
            if draw % 8 > 4:  # a number follows, which the pattern takes for more of this one
                ip = draw % 8 < 7
                after = [f"{a}.{int(b) % 256}.{draw % 200}.{c[:2]}" if ip and int(a) < 256 else
                         f"{11 + draw % 240}.{int(b) % 256}.{draw % 200}.{int(c) % 256}"
                         if ip else own[:5]]
                after_tags = ["B-ip" if ip else "O"]
        elif kind == "card":
            short = with_check_digit(digits[:12 + draw % 3])
            written = ([short], [f"{short[:4]}-{short[4:10]}-{short[10:]}"],
                       [short[:4], short[4:10], short[10:]])[draw // 3 % 3]
        else:
            continue
        mine = ["B-" + kind] + ["I-" + kind] * (len(written) - 1)
        yield (words[:i] + list(written) + after + words[j:],
               tags[:i] + mine + after_tags + tags[j:])


def labelled_windows(text: str) -> list[tuple[list[str], list[str]]]:
    """Windows of words with tags, around the patterns' finds and other marked words, and variants."""
    spans = [m.span() for m in _WORD.finditer(text)]
    tags = ["O"] * len(spans)
    base, w = sorted((s, e, k) for k, s, e in base_spans(text)), 0
    for s, e, kind in base:
        while w < len(spans) and spans[w][1] <= s:
            w += 1
        first = v = w
        while v < len(spans) and spans[v][0] < e:
            if tags[v] == "O":
                tags[v] = ("B-" if v == first else "I-") + kind
            v += 1
    words = [text[s:e] for s, e in spans]
    out, after = [], 0
    for i, word in enumerate(words):
        if i >= after and _MARK.search(word):
            a, b = max(0, i - AROUND), min(len(words), i + 2 * AROUND)
            while a and tags[a].startswith("I-"):
                a -= 1
            out.append((words[a:b], tags[a:b]))
            after = b
            if len(out) >= WINDOWS_EACH:
                break
    more = []
    for own, gold in out:
        draw = zlib.crc32(" ".join(own).encode())
        for k in range(VARIANTS_EACH):
            more += variants(own, gold, draw // 8 ** k)
    return out + more


def labelled_table(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """(words, tags): the labelled windows of a bounded sample of documents, chosen by hash."""
    draw = F.xxhash64("doc_id")
    chosen = [r[0] for r in docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
              .orderBy(draw, "doc_id").limit(sample).collect()]

    def label(batches):
        for batch in batches:
            found = [w for t in batch.column("text").to_pylist() for w in labelled_windows(t or "")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.list_(pa.string())),
                 pa.array([t for _, t in found], pa.list_(pa.string()))], ["words", "tags"])

    return docs.filter(F.col("doc_id").isin(chosen)).select("text").mapInArrow(
        label, "words array<string>, tags array<string>")


def train(labelled: DataFrame) -> ChainField:
    """The field trained on a small table of (words, tags); its size is the caller's bound."""
    rows = sorted((r["words"], r["tags"]) for r in labelled.collect())
    return ChainField().train([(w, [TAGS.index(t) for t in tags]) for w, tags in rows if w])


def added_spans(model: ChainField, text: str, base: list, runs: list, tags: list):
    """Spans of the field's tags that read as their kind and touch no base span."""
    taken = sorted((s, e) for _, s, e in base)
    out = []
    for words, best in zip(runs, tags):
        i = 0
        while i < len(words):
            if best[i] == 0:
                i += 1
                continue
            kind, j = TAGS[best[i]][2:], i + 1
            while j < len(words) and TAGS[best[j]] == "I-" + kind:
                j += 1
            begin, end = words[i][0], words[j - 1][1]
            i = j
            for s, e in beside_spans(begin, end, taken):
                while s < e and not (text[s].isalnum() or text[s] in "+("):
                    s += 1
                while e > s and not text[e - 1].isalnum():
                    e -= 1
                if plausible(kind, text[s:e]):
                    out.append((kind, s, e))
    return out


def beside_spans(begin: int, end: int, taken: list[tuple[int, int]]):
    """The parts of a stretch that no span covers."""
    for a, b in taken:
        if a < end and begin < b:
            if begin < a:
                yield begin, a
            begin = max(begin, b)
    if begin < end:
        yield begin, end


def search(model: ChainField, texts: list[str]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, in the order of KINDS, then start."""
    place = {k: i for i, k in enumerate(KINDS)}
    base = [base_spans(t) for t in texts]
    runs = [marked_runs(t) if model.own and _MARK.search(t) else [] for t in texts]
    flat = [[t[s:e] for s, e in run] for t, own in zip(texts, runs) for run in own]
    tags, at, out = model.decode(flat), 0, []
    for text, own, found in zip(texts, runs, base):
        more = added_spans(model, text, found, own, tags[at:at + len(own)])
        at += len(own)
        out.append((found, sorted(found + more, key=lambda x: (place[x[0]], x[1]))))
    return out


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_personal_data(docs: DataFrame, model: ChainField | None = None) -> DataFrame:
    """doc_id, counts of the base finds by kind, their digest, and all spans."""
    model = train(labelled_table(docs)) if model is None else model

    def find(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                found = search(model, [t or "" for t in batch.column("text").to_pylist()])
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found],
                                   pa.int64()) for k in KINDS]
                sums = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *counts, pa.array(sums, pa.string()),
                     pa.array([joined(s) for _, s in found], pa.string())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        find, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
        + ", base_sha256 string, spans string")
