"""Personal data: base patterns, and a linear-chain conditional random field over word shapes.

The field labels words as outside, name or secret (begin, inside) from the shapes of the word and its two
neighbours and from cue words, and is trained on a small labelled table by its likelihood's gradient. Viterbi
decodes the lines of a group of texts side by side in numpy; a line is one sequence, however long. Its spans come on top of the base patterns' spans, which always stay.

Nulls and empty texts have no spans. Equal texts get equal spans, rows repeat as they came, further columns are ignored, and an
empty table gives an empty result. All scans are linear in a text's length.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from folioframe.llm.common import per_text, table, worker_cache

BASE, ADDED = ("email", "ip", "card", "phone"), ("name", "secret")
LABELS = ("O", "B-name", "I-name", "B-secret", "I-secret")
GROUP_WORDS, KNOWN_WORDS = 400_000, 300_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")  # a later start in the same run of digits fails like the first
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost and non-overlapping within a kind."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((*m.span(), "phone"))
    return out


def shape(word: str) -> str:
    """Upper case X, lower case x, digits 9, others as they are; runs collapse, and long mixed words become MIX."""
    kinds = ["X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word]
    runs = [c for i, c in enumerate(kinds) if not i or c != kinds[i - 1]]
    core = [c for c in runs if c in "Xx9"]
    if len(word) >= 16 and set(core) == {"X", "9"} and core == runs:
        return "KEY"
    if len(core) > 5 and "9" in core and len(word) >= 16:
        return "MIX@" if "@" in word else "MIX"
    if len(word) >= 24 and set(core) == {"x"}:
        return "LONG"
    return "".join(runs[:6]) if len(runs) <= 6 else "OTHER"


_STRIP = ".,;:!?\"'()[]"


def cue_of(word: str) -> str:
    """What may be a cue: the bare word, or what stands before an equals sign inside it."""
    low = word.strip(_STRIP).lower() or word
    head, sign, value = low.partition("=")
    return head + sign if head and value else low


def word_class(word: str, cues) -> tuple[str, str]:
    low = cue_of(word)
    return shape(word), low if low in cues else ""


#: Fixed values of the labelled table: fillers of its templates, and the templates; marks {N} a name of one to three words, {S} a long
#: secret, {K} an access key of upper-case letters and digits, {W} a short password; a mark may end a word.
GIVEN = "Anna Boris Clara David Elena Frank Greta Hugo Irene Jonas Klara Louis Maria Nadia Oscar Paula Quentin Rosa Simon Teresa".split()
FAMILY = "Adler Berger Costa Dubois Engel Ferrari Garcia Hoffmann Ivanov Jensen Keller Lopez Moreau Novak Olsen Peters Romano Schmidt Torres Weber".split()
TEMPLATES = (
    "please contact Mr. {N} about the order",
    "Dear Mrs. {N} , thank you for the letter",
    "Dr. {N} signed the report on Monday",
    "it was seen by Dr. {N} and then sent",
    "my name is {N} and this is the place",
    "name: {N}",
    "Ms. {N}",
    "a note from Prof. {N} on the table",
    "token = {S} and more of the text",
    "of the and token = {S}",
    "token = {S}",
    "password: {S}",
    "api_key = {S} in the file",
    "secret: {S}",
    "set password = {S} now",
    "password={S} and",
    "the pwd={W} of the",
    "token={S}",
    "api_key={S} here",
    "secret={W}",
    "password={W}",
    "password: {W}",
    "passwd: {W} for the host",
    "Bearer {S}",
    "key {K} of the account",
    "of the {K} and more",
    "{K} is the key",
    "and {K}",
    "Contact: {N} , manager",
    "Contact: {N}",
    "Author: {N} and others",
    "Kind regards, {N}",
)
PLAIN = (
    "The house was on the hill and it rained.",
    "In the end The was a word",
    "Of.\tThe. And",
    "On Monday the order was sent to the place.",
    "It is 42 of 100 and version 2.0 of the work",
    "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the General Public License",
    "El de la casa que ésta en el lugar",
    "Die das und der Einheit ist eine Sache von der",
    "Une maison est là, sur la place. Élan",
    "call +1 (555) 555-0100 or 4111111111111111 today",
    "write to of.12@mail1.example.com the 10.1.2.3 host",
    "THE AND!! OF!! 12345",
    "a | b | word | cell | Another | 99",
    "word%%% An*** the&&& of### Thing$$$",
    "the token was new and the name of it is long",
    "and = or = 12",
    "Was the password of the key a secret one",
    "Xx Of And Thing The Of Was That",
    "extraordinarilylongcompoundwordwithoutend und die",
    "mode=fast size=10 and color=red x=1 of the",
    "see ISO9001 and model XYZ2000 or A12 of the ABC123",
    "https://www.example.com/page1?a=1&b=abc12&c=2 and the rest",
    "Contact: the office",
    "by. That is the house of the hill , by. Another",
    "it was. By. Then on",
    "the key of the account and a password",
)
SYLLABLES = "an de er in on th re la ou es mi na so ti que ra".split()


def labelled_table(seed: int = 3, repeats: int = 8, given=GIVEN, family=FAMILY) -> list[tuple[list[str], list[int]]]:
    """The small table that the field learns from: words and label numbers."""
    rng = random.Random(seed)
    out = [(p.split(), [0] * len(p.split())) for p in PLAIN for _ in range(3)]
    for _ in range(240):  # plain sentences of invented words: short ones, capitals after a stop or anywhere
        words = ["".join(rng.choices(SYLLABLES, k=rng.choice([1, 1, 2, 3, 4]))) for _ in range(rng.randrange(1, 12))]
        for i, w in enumerate(words):
            end = rng.choice(["", "", "", ".", ".", ",", "!!"])
            up = not i or words[i - 1][-1] in ".!" or rng.random() < 0.15
            words[i] = (w.upper() if rng.random() < 0.05 else w.capitalize() if up else w) + end
        out.append((words, [0] * len(words)))
    out += [([w] * n, [0] * n) for w in ("And", "Is", "Rea", "La") for n in (3, 9, 16)]
    for _ in range(60):  # a secret or a titled name among plain words
        words = ["".join(rng.choices(SYLLABLES, k=rng.choice([1, 2, 3]))) for _ in range(rng.randrange(2, 9))]
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        value = "".join(rng.choices("0123456789abcdef", k=18)) if kind else rng.choice(["AKIA", "ASIA", "ABCD"]) + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=16))
        words[at] = value if not kind else rng.choice(["password=", "token=", "secret="]) + value
        out.append((words, [3 * (i == at) for i in range(len(words))]))
    for t in TEMPLATES * repeats:
        words, labels = [], []
        for w in t.split():
            if w == "{N}":
                name = [rng.choice(given)] * (rng.random() < 0.8) + [rng.choice(family)] * 1
                if rng.random() < 0.2:
                    name.insert(1, rng.choice("ABCDEFG") + ".")
                words += name
                labels += [1] + [2] * (len(name) - 1)
            elif w[-3:] in ("{K}", "{W}") or w != "{S}" and w.endswith("{S}"):
                upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "".join(rng.choices(SYLLABLES, k=rng.choice([2, 3])))
                made = {"{K}": rng.choice(["AKIA", "ASIA", "".join(rng.choices(upper[:26], k=4))]) + "".join(rng.choices(upper, k=rng.choice([12, 16, 16, 20]))), "{W}": rng.choice([lower, lower.capitalize()]) + rng.choice(["1", "42", "2024", "7!", "#9"]), "{S}": "".join(rng.choices("0123456789abcdef", k=rng.choice([16, 18, 24, 32])))}
                words.append(w[:-3] + made[w[-3:]])
                labels.append(3)
            elif w == "{S}":
                s = "".join(rng.choices("0123456789abcdef", k=rng.choice([24, 32, 40]))) if rng.random() < 0.7 else "".join(rng.choices("0123456789abcdefABCDEFGHJKLMNPqrstuvwxyz", k=28))
                words.append(rng.choice(['"%s"', "%s", "'%s'", '"%s";', "%s."]) % s)
                labels.append(3)
            else:
                words.append(w)
                labels.append(0)
        out.append((words, labels))
    return out


def train(rows, steps: int = 150, rate: float = 0.15, ridge: float = 0.005) -> dict:
    """Weights by Adam on the penalised log likelihood, all sentences at once: forward and backward sums by position."""
    words = [w for ws, _ in rows for w in ws]
    counts: dict[str, int] = {}
    for w in words:
        low = cue_of(w)
        counts[low] = counts.get(low, 0) + 1
    cues = {w for w, n in counts.items() if n >= 6 and not any(c.isdigit() for c in w)} - {x.lower() for x in [*GIVEN, *FAMILY]}
    shapes = {s: i + 2 for i, s in enumerate(sorted({shape(w) for w in words}))}  # 0 beyond the sentence, 1 unknown
    cue_ids = {c: i + 1 for i, c in enumerate(sorted(cues))}
    n_s, n_c, n_l = len(shapes) + 2, len(cue_ids) + 1, len(LABELS)
    size, most = len(rows), max(len(w) for w, _ in rows)
    sid, cid = np.zeros((size, most + 2), int), np.zeros((size, most + 2), int)
    y, live = np.zeros((size, most), int), np.zeros((size, most), bool)
    for i, (ws, ls) in enumerate(rows):
        for t, w in enumerate(ws):
            s, c = word_class(w, cues)
            sid[i, t + 1], cid[i, t + 1] = shapes[s], cue_ids.get(c, 0)
        y[i, : len(ls)], live[i, : len(ls)] = ls, True
    theta = {"s": np.zeros((3, n_s, n_l)), "c": np.zeros((3, n_c, n_l)), "t": np.zeros((n_l, n_l)), "b": np.zeros(n_l)}
    m = {k: np.zeros_like(v) for k, v in theta.items()}
    v2 = {k: np.zeros_like(v) for k, v in theta.items()}
    hot = np.eye(n_l)[y] * live[:, :, None]
    pair = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:])
    total = live.sum(1)
    lse = lambda a, axis: (top := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - top).sum(axis))
    for step in range(1, steps + 1):
        e = sum(theta["s"][d][sid[:, d : d + most]] + theta["c"][d][cid[:, d : d + most]] for d in range(3))
        alpha = np.zeros((size, most, n_l))
        alpha[:, 0] = theta["b"] + e[:, 0]
        for t in range(1, most):
            new = lse(alpha[:, t - 1, :, None] + theta["t"], 1) + e[:, t]
            alpha[:, t] = np.where(live[:, t, None], new, alpha[:, t - 1])
        beta = np.zeros((size, most, n_l))
        for t in range(most - 2, -1, -1):
            new = lse(theta["t"] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(live[:, t + 1, None], new, 0)
        z = lse(alpha[np.arange(size), total - 1], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * live[:, :, None]
        both = np.exp(alpha[:, :-1, :, None] + theta["t"] + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * live[:, 1:, None, None]
        gap = hot - p
        grad = {"t": pair - both.sum((0, 1)), "b": gap[:, 0].sum(0), "s": np.zeros_like(theta["s"]), "c": np.zeros_like(theta["c"])}
        for d in range(3):
            np.add.at(grad["s"][d], sid[:, d : d + most], gap)
            np.add.at(grad["c"][d], cid[:, d : d + most], gap)
        for k in theta:
            g = grad[k] / size - ridge * theta[k] / 10
            m[k] = 0.9 * m[k] + 0.1 * g
            v2[k] = 0.999 * v2[k] + 0.001 * g * g
            theta[k] = theta[k] + rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)
    for k in ("s",):  # a shape that was never seen pulls towards outside
        theta[k][1, 1] = np.eye(n_l)[0] * 2
    return {"shapes": shapes, "cues": cue_ids, **theta}


class Field:
    """A trained field with a table of the words seen, bounded."""

    def __init__(self, model: dict):
        self.shapes, self.cues = model["shapes"], model["cues"]
        n_c = len(self.cues) + 1
        s, c = model["s"].astype(np.float32), model["c"].astype(np.float32)
        # one row for each (shape, cue), for the word itself and its two neighbours
        self.emit = [(s[d][:, None, :] + c[d][None, :, :]).reshape(-1, s.shape[2]).copy() for d in range(3)]
        self.width = n_c
        self.move, self.first = model["t"].astype(np.float32), model["b"].astype(np.float32)
        self.known: dict[bytes, int] = {}

    def look(self, word: bytes) -> int:
        s, c = word_class(word.decode("utf-8", "replace"), self.cues)
        got = self.shapes.get(s, 1) * self.width + self.cues.get(c, 0)
        if len(self.known) >= KNOWN_WORDS:
            self.known.clear()
        if len(word) <= 64:
            self.known[word] = got
        return got

    def classes(self, words: list[bytes]) -> list[int]:
        get = self.known.get
        return [self.look(w) if (c := get(w)) is None else c for w in words]

    def viterbi(self, ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Labels of sequences that lie one after another; the longest first inside, so that each step is one slice."""
        # neighbours: rows of class 0 stand beyond a line's ends
        begin = np.cumsum(lens) - lens
        before, after = np.empty_like(ids), np.empty_like(ids)
        before[1:], after[:-1] = ids[:-1], ids[1:]
        before[begin], after[begin + lens - 1] = 0, 0
        e = self.emit[0][before] + self.emit[1][ids] + self.emit[2][after]
        order = np.argsort(-lens, kind="stable")
        start, size = begin[order], lens[order]
        most = int(size[0]) if len(size) else 0
        count = np.searchsorted(-size, -np.arange(1, most + 1), side="right")
        back = np.zeros((len(ids), len(LABELS)), np.int8)
        v = self.first + e[start]
        for t in range(1, most):
            m = count[t]
            at = start[:m] + t
            if t % 64 == 0:  # values of a long line would outgrow single precision; only their differences count
                v[:m] -= v[:m].max(1, keepdims=True)
            step = v[:m, :, None] + self.move
            arg = step.argmax(1)
            back[at] = arg
            v[:m] = np.take_along_axis(step, arg[:, None, :], 1)[:, 0] + e[at]
        out = np.zeros(len(ids), np.int8)
        now = v.argmax(1)
        for t in range(most - 1, -1, -1):
            m = count[t]
            at = start[:m] + t
            out[at] = now[:m]
            now[:m] = back[at, now[:m]]
        return out

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        group, ids, lens = [], [], []

        def flush():
            if ids:
                labels = self.viterbi(np.array(ids), np.array(lens))
                for i, a, b in group:
                    if labels[a:b].any():
                        out[i] = self._marked(texts[i], labels[a:b])
            group.clear(), ids.clear(), lens.clear()

        for i, t in enumerate(texts):
            a = len(ids)
            for line in t.encode("utf-8", "surrogatepass").split(b"\n"):
                got = self.classes(line.split())
                if got:
                    ids += got
                    lens.append(len(got))
            group.append((i, a, len(ids)))
            if len(ids) >= GROUP_WORDS:
                flush()
        flush()
        return out

    @staticmethod
    def _marked(text: str, labels: np.ndarray) -> list[tuple[int, int, str]]:
        found, last = [], None
        for (a, b), y in zip((m.span() for m in _WORD.finditer(text)), labels.tolist()):
            kind = LABELS[y][2:]
            if kind and LABELS[y][0] == "I" and last and last[2] == kind and "\n" not in text[last[1] : a]:
                last[1] = b
            elif kind:
                last = [a, b, kind]
                found.append(last)
            else:
                last = None
        out = []
        for a, b, kind in found:
            while a < b and text[a] in _STRIP:
                a += 1
            while b > a and text[b - 1] in _STRIP:
                b -= 1
            if a < b:
                out.append((a, b, kind))
        return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    order = {k: i for i, k in enumerate((*BASE, *ADDED))}
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], order[s[2]], s[1])))


def find(docs: DataFrame, rows=None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans). rows: the labelled table, its own by default."""
    model = docs.sparkSession.sparkContext.broadcast(train(rows or labelled_table()))
    version = hashlib.md5(repr(sorted(model.value["shapes"])).encode() + model.value["s"].tobytes()).hexdigest()

    def score(texts):
        field = worker_cache(("pii", version), lambda: Field(model.value))
        out: dict[str, list] = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        for t, added in zip(texts, field.spans(texts)):
            base = base_spans(t)
            kinds = [k for *_, k in base]
            for k in BASE:
                out[f"n_{k}"].append(kinds.count(k))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(base + added))
        return out

    return per_text(docs, score, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
