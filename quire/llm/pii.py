"""Personal data: high-recall generators, boosted trees, calibrated thresholds.

Generators propose spans that may overlap, also within a kind: an account number
or telephone number is proposed with each of the groups that it may end at. Spans
of the base kinds (email, ip, card, phone) that pass their format's test are always
personal data. All others are candidates: gradient-boosted trees over format and
context features give each a score, a logistic fit on held-out candidates
calibrates it, and a kind's threshold is the lowest that reaches PRECISION there.
Of overlapping spans the base one, then the likelier, then the longer and earlier
stays.

The trees learn from the proposals on texts that are made here by a seeded
generator, with personal data, look-alikes and numbers that can't be told apart, in
and out of the contexts that mark them; they read no table. Features see 40
characters before a span and 20 after it. Formats bound what is proposed: 64
characters of a masked address's local part and of a domain's label, 34 of an
account number, 15 digits of a telephone number.

Null and empty texts have no span. Texts are read whole, every pattern in time
linear in the text. Repeated rows are read alike; an empty table gives an empty
table; null ids are passed through and other columns aren't read.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BASE = ("email", "ip", "card", "phone")
MORE = ("iban", "local_phone", "masked_email", "secret", "short_card", "ssn")
PRECISION = 0.97

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_GROUP = re.compile(r" ?[A-Z0-9]{1,31}(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.,/-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[ ./-][0-9](?:[ ./-]?[0-9]){5,13}(?![0-9])")
_SHORT_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,14}(?![0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_GROUPS = re.compile(r"[0-9]+|\([0-9]+\)")
_MASKED_AT = re.compile(r"[\[({] ?at ?[\])}]", re.I)
_MASKED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[({] ?at ?[\])}] ?[A-Za-z0-9-]{1,64}(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]{2,64})+", re.I)
_MASKED_DOT = re.compile(r" ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]{2,64}", re.I)
_NAMED = re.compile(r"(?:password|passwd|token|secret|api[_-]?key)[\"']?[ \t]*[=:][ \t]*[\"']?([^\s\"']{6,})", re.I)
_SAID = re.compile(r"(?:bearer|token|password|secret|api[ _-]?key)[ \t]+(?:is[ \t]+)?[\"']?([^\s\"'=:]{8,})", re.I)
_ISSUED = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{16,}|sk[-_][A-Za-z0-9_-]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]+)?)(?![A-Za-z0-9])")
_RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}")
_CONTEXT = tuple(re.compile(p, re.I) for p in (
    r"phone|tel\b|tel\.|call|fax|mobile|cell", r"ssn|social|security", r"iban|account|bank|transfer", r"password|passwd|token|secret|key",
    r"order|invoice|ref|item|part|isbn|version|release|page|date|year|no\.|nr\.", r"mail|contact|write|reach", r"[$€£%]\s*$", r"\b(?:my|his|her|their|your|name|mr|mrs|born)\b"))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, each kind leftmost and without overlap within it."""
    out = []
    end = 0
    at = text.find("@")
    while at >= 0:
        # An address starts where its local part's run does, unless a match ended inside it.
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            end = found.end()
        at = text.find("@", max(at + 1, end))
    if not _DIGIT.search(text):
        return out
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
                out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans of further kinds, proposed for recall; they may overlap, within a kind too."""
    out = []
    if _DIGIT.search(text):
        for m in _IBAN.finditer(text):
            end, n = m.end(), 4
            # Of a number that stands apart from what follows, each group may be the last.
            while n <= 34 and (group := _IBAN_GROUP.match(text, end)):
                n, end = n + len(group[0].lstrip()), group.end()
                if 15 <= n <= 34:
                    out.append(("iban", m.start(), end))
        for m in _LOCAL_PHONE.finditer(text):
            groups = [g.span() for g in _GROUPS.finditer(text, *m.span())]
            for first in range(min(2, len(groups))):
                n = 0
                for a, b in groups[first:]:
                    n += b - a
                    if b == m.end() or (7 <= n and first == 0):
                        out.append(("local_phone", groups[first][0], b))
        out += [("short_card", *m.span()) for m in _SHORT_CARD.finditer(text)]
        out += [("ssn", *m.span()) for m in _SSN.finditer(text)]
        out += [("secret", *m.span()) for m in _RANDOM.finditer(text)]
    if _MASKED_AT.search(text):
        for m in _MASKED.finditer(text):
            domain = _MASKED_AT.search(text, m.start()).end()
            out += [("masked_email", m.start(), d.end()) for d in _MASKED_DOT.finditer(text, domain, m.end())]
    for pattern in (_NAMED, _SAID, _ISSUED):
        for m in pattern.finditer(text):
            a, b = m.span(m.lastindex or 0)
            out.append(("secret", a, b))
            if (c := len(text[a:b].rstrip(".,;:!?)]}<>"))) >= 6:
                out.append(("secret", a, a + c))
    return list(dict.fromkeys(out))


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span and what stands around it."""
    span, before, after = text[start:end], text[max(0, start - 40) : start], text[end : end + 20]
    digits = "".join(c for c in span if c.isdigit() and c.isascii())
    counts = Counter(span)
    groups = [len(x) for x in re.split(r"[^A-Za-z0-9]+", span) if x]
    plain = re.sub(r"[^A-Za-z0-9]", "", span).upper()
    mod97 = kind == "iban" and plain.isascii() and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4]) or 0) % 97 == 1
    return [
        *(float(kind == k) for k in MORE), float(len(span)), float(len(digits)), len(digits) / len(span), sum(c.isupper() for c in span) / len(span), sum(c.islower() for c in span) / len(span),
        -sum(n / len(span) * math.log2(n / len(span)) for n in counts.values()), float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)), float(bool(digits) and luhn(digits)), float(mod97),
        float(bool(_ISSUED.fullmatch(span))), float(bool(re.search(r"[.,;:!?)\]}]$", span))), float(bool(re.match(r"[ .-]?[0-9]", after))), float(bool(re.match(r" [A-Z0-9]{2,4}\b", after))),
        float(span[:1] == "0"), float(span[:1] == "("), float(bool(re.search(r"(?:19|20)[0-9]{2}", span))), float(before[-1:].isalnum()), float(after[:1].isalnum()), *(float(bool(p.search(before))) for p in _CONTEXT),
    ]


@dataclass
class Trees:
    """Boosted regression trees of depth 3 in arrays: 7 splits and 8 leaves each."""

    column: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for column, cut, leaf in zip(self.column, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(3):
                node = 2 * node + 1 + (x[np.arange(len(x)), column[node]] > cut[node])
            out += leaf[node - 7]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, rate: float = 0.3, l2: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss over candidate cuts at quantiles."""
    cuts = [np.unique(np.quantile(x[:, c], np.linspace(0.05, 0.95, 15))) for c in range(x.shape[1])]
    bias = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    trees = Trees(np.zeros((0, 7), np.int64), np.zeros((0, 7)), np.zeros((0, 8)), bias)
    margin = np.full(len(y), bias)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        column, cut, leaf = np.zeros(7, np.int64), np.full(7, np.inf), np.zeros(8)
        node = np.zeros(len(y), np.int64)
        for level in range(3):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                at = np.flatnonzero(node == k)
                best = 1e-6
                for c in range(x.shape[1]):
                    right = x[at, c][:, None] > cuts[c][None, :]
                    gr, hr = g[at] @ right, h[at] @ right
                    gain = gr**2 / (hr + l2) + (g[at].sum() - gr) ** 2 / (h[at].sum() - hr + l2) - g[at].sum() ** 2 / (h[at].sum() + l2)
                    if len(gain) and gain.max() > best:
                        best, column[k], cut[k] = gain.max(), c, cuts[c][gain.argmax()]
            node = 2 * node + 1 + (x[np.arange(len(y)), column[node]] > cut[node])
        for k in range(8):
            at = node == k + 7
            leaf[k] = -rate * g[at].sum() / (h[at].sum() + l2)
        margin += leaf[node - 7]
        trees.column, trees.cut, trees.leaf = np.vstack([trees.column, column]), np.vstack([trees.cut, cut]), np.vstack([trees.leaf, leaf])
    return trees


def made_texts(rng: np.random.Generator, n: int) -> list[tuple[str, set[tuple[str, int, int]]]]:
    """Made texts with the spans in them that are personal data."""
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    digit = lambda k: "".join(str(int(d)) for d in rng.integers(0, 10, k))
    word = lambda: "".join(pick("etaoinshrdlu") for _ in range(int(rng.integers(2, 8))))
    filler = lambda k: " ".join(word() for _ in range(k))
    some = lambda alphabet, k: "".join(pick(alphabet) for _ in range(k))
    small, large, hex_ = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"

    def iban(good: bool) -> str:
        country, body = pick(["DE", "FR", "ES", "GB", "NL"]), digit(int(rng.integers(12, 24)))
        number = int("".join(str(int(c, 36)) for c in body + country + "00"))
        check = 98 - number % 97 if good else (98 - number % 97 + int(rng.integers(1, 96))) % 97
        plain = f"{country}{check:02d}{body}"
        return plain if rng.random() < 0.5 else " ".join(plain[i : i + 4] for i in range(0, len(plain), 4))

    def card(good: bool) -> str:
        body = pick(["34", "37"]) + digit(12)
        last = next(d for d in "0123456789" if luhn(body + d) == good)
        plain = body + last
        return plain if rng.random() < 0.5 else f"{plain[:4]} {plain[4:10]} {plain[10:]}"

    phone = lambda: pick([f"({digit(3)}) {digit(3)}-{digit(4)}", f"0{digit(2)} {digit(4)} {digit(4)}", f"{digit(3)}-{digit(3)}-{digit(4)}", f"0{digit(3)}/{digit(6)}", f"{digit(3)}.{digit(3)}.{digit(4)}"])
    other_number = lambda: pick([f"{digit(4)}-{digit(2)}-{digit(4)}", f"{digit(3)} {digit(3)} {digit(3)}", phone(), f"19{digit(2)}-20{digit(2)}", f"{digit(2)}.{digit(2)}.20{digit(2)}", f"{digit(2)} {digit(3)} {digit(3)} {digit(3)}"])
    random_ = lambda: pick([some(hex_, 32), some(hex_, 40), some(small + large + "0123456789", 24), some(small + large + "0123456789_-", 36)])
    issued = lambda: pick(["AKIA" + some(large + "0123456789", 16), "ghp_" + some(small + large + "0123456789", 24), "sk-" + some(small + "0123456789", 24), "xoxb-" + digit(10) + "-" + some(small + "0123456789", 12)])
    key = lambda: pick([some(hex_, 18), word() + digit(4), word() + "!" + digit(3), some("abcXYZ0189_", 24), random_(), issued()])
    dull = lambda: pick([word() + "ing", word() + word(), "required", "changes", "forgotten", "protected"])
    tail = lambda: pick([" ", " ", ". ", ", ", f" BIC {some(large, 8)} ", " AND ", f" {digit(2)} ", " THE "])
    # Kind, what stands before, the span, whether it is personal data, how often.
    kinds = [
        ("iban", ["IBAN ", "account ", "bank transfer to ", ""], lambda: iban(True), True, 3), ("iban", ["item ", "ref ", "part ", "IBAN "], lambda: iban(False), False, 2),
        ("local_phone", ["phone ", "call me at ", "tel. ", "fax: ", "my cell ", ""], phone, True, 4), ("local_phone", ["order no. ", "pages ", "release ", "date ", "ref ", "", "$ "], other_number, False, 4),
        ("ssn", ["SSN ", "social security ", "my number is ", ""], lambda: f"{int(rng.integers(1, 666)):03d}-{int(rng.integers(1, 100)):02d}-{int(rng.integers(1, 10000)):04d}", True, 2),
        ("ssn", ["part ", "order ", "item ", "version ", ""], lambda: f"{pick(['000', '666', '9' + digit(2), digit(3)])}-{digit(2)}-{digit(4)}", False, 1),
        ("masked_email", ["contact ", "mail ", "write to ", ""], lambda: f"{word()}{pick(['.', '', '_'])}{word()} {pick(['[at]', '(at)', '{at}'])} {word()} {pick(['[dot]', '(dot)', '.'])} {pick(['com', 'org', 'net', 'de'])}", True, 2),
        ("masked_email", ["meet ", "see ", ""], lambda: f"{word()} (at) {word()} . {word()}", False, 1),
        ("secret", ["password=", "token = \"", "api_key: ", "secret=", "Authorization: Bearer ", "token ", "the password is "], key, True, 4), ("secret", ["token: ", "password = ", "secret: ", "the token ", "a bearer ", "password is "], dull, False, 3),
        ("secret", ["", "use ", "with "], issued, True, 2), ("secret", ["commit ", "checksum ", "sha1 ", "build ", "https://" + "x/"], lambda: pick([some(hex_, 40), some(hex_, 32)]), False, 2),
        ("secret", [""], lambda: "-".join(word() + pick(["", "", "2"]) for _ in range(6)) + pick(["", "1"]), False, 2),
        ("short_card", ["card ", "pay with ", "amex ", ""], lambda: card(True), True, 2), ("short_card", ["order ", "serial ", "ean ", "timestamp ", ""], lambda: pick([card(False), digit(13), digit(14)]), False, 3),
    ]
    order = [k for k in kinds for _ in range(k[4])]
    out = []
    for _ in range(n):
        text, true = filler(3) + " ", set()
        for _ in range(int(rng.integers(1, 4))):
            kind, before, make, good, _ = pick(order)
            text += pick(before)
            span = make()
            if good:
                true.add((kind, len(text), len(text) + len(span)))
            text += span + ('"' if text.endswith('"') else "") + tail() + filler(int(rng.integers(2, 6))) + " "
        out.append((text, true))
    return out


def _examples(rng: np.random.Generator, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of what is proposed on made texts, and whether it is just the span of personal data."""
    x, y = [], []
    for text, true in made_texts(rng, n):
        for span in candidates(text):
            x.append(features(text, *span))
            y.append(span in true)
    return np.array(x, np.float64), np.array(y, np.float64)


@dataclass
class Model:
    trees: Trees
    thresholds: dict[str, float]


@functools.lru_cache(maxsize=1)
def train(seed: int = 3, n: int = 2500) -> Model:
    rng = np.random.default_rng(seed)
    trees = boost(*_examples(rng, n))
    hx, hy = _examples(rng, n)
    raw = trees.raw(hx)
    for _ in range(50):  # Newton steps of the logistic calibration
        p = 1 / (1 + np.exp(-np.clip(trees.slope * raw + trees.shift, -30, 30)))
        d, w = p - hy, p * (1 - p) + 1e-6
        m = np.array([[(w * raw * raw).sum() + 1e-3, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(m, [(d * raw).sum(), d.sum()])
        trees.slope, trees.shift = trees.slope - step[0], trees.shift - step[1]
    p = trees.probability(hx)
    thresholds = {}
    for i, kind in enumerate(MORE):
        own = hx[:, i] == 1
        order = np.argsort(-p[own], kind="stable")
        right = np.cumsum(hy[own][order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(right >= PRECISION)
        thresholds[kind] = float(p[own][order][good[-1]]) if len(good) else 1.1
    return Model(trees, thresholds)


def find(texts: list[str | None], model: Model) -> list[list[tuple[str, int, int]]]:
    """Each text's spans, by kind (base kinds first) and start."""
    rank = {k: i for i, k in enumerate((*BASE, *MORE))}
    out, asked, rows = [], [], []
    for i, text in enumerate(texts):
        out.append(base_spans(text) if text else [])
        for span in candidates(text) if text else []:
            asked.append((i, span))
            rows.append(features(text, *span))
    if rows:
        p = model.trees.probability(np.array(rows))
        more: dict[int, list[tuple[float, str, int, int]]] = {}
        for (i, span), score in zip(asked, p, strict=True):
            if score >= model.thresholds[span[0]]:
                more.setdefault(i, []).append((float(score), *span))
        for i, found in more.items():
            # What the base kinds cover is taken as a whole; of the rest, the likelier first.
            taken: list[tuple[int, int]] = []
            for _, a, b in sorted(out[i], key=lambda s: s[1:]):
                if taken and a <= taken[-1][1]:
                    taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
                else:
                    taken.append((a, b))
            for _, kind, a, b in sorted(found, key=lambda s: (-s[0], s[2], -s[3], s[1])):
                at = bisect.bisect_left(taken, (b, -1))  # the last taken one that starts before b
                if at == 0 or taken[at - 1][1] <= a:
                    taken.insert(at, (a, b))
                    out[i].append((kind, a, b))
    return [sorted(s, key=lambda x: (rank[x[0]], x[1])) for s in out]


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and spans of every row."""
    slim = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))
    model = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [s for i in range(0, batch.num_rows, 500) for s in find(batch.column(1).slice(i, 500).to_pylist(), model)]
            base = [[s for s in x if s[0] in BASE] for x in spans]
            counts = [pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in BASE]
            sha = pa.array([hashlib.sha256(_written(x).encode()).hexdigest() for x in base], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, sha, pa.array([_written(x) for x in spans], pa.string())], ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span, or each run of overlapping ones, replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the spans of ``text`` replaced; other columns, whatever their names, pass through."""
    model, place = train(), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            clean = [None if t is None else redact(t, s) if s else t for i in range(0, len(texts), 500) for t, s in zip(texts[i : i + 500], find(texts[i : i + 500], model), strict=True)]
            columns = list(batch.columns)
            columns[place] = pa.array(clean, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
