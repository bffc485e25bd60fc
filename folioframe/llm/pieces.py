"""Merge-type (BPE) SentencePiece encoding by a prefix table, and decoding.

For each prefix of a unit the table holds the one token that ends the prefix's encoding. Candidates
are the automaton's matches that end there; one fits if it stands beside the last token of the
prefix before it, that is if merging both strings gives just the two. Ids are recovered backwards.
Work is linear in a text's length (a piece's length is bounded), whole texts always.

A text is cut where no piece of the vocabulary can lie: before a run of spaces and at new lines (both
checked when the model is loaded). Encodings of short units are kept in a bounded table.

Nulls are empty texts; an empty text has no ids. Rows repeat as they came; further columns are ignored by
encode_documents(). An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from folioframe.llm.common import per_text, table, worker_cache

#: Entries of each of the two tables of short units, their longest length, and entries of the pair table.
UNITS, UNIT_CHARS, PAIRS = 150_000, 40, 400_000
SPACE = "▁"
_NEVER = float("inf")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_model(path: str) -> dict:
    """What encoding needs, as plain values: pieces, scores, and the ids of bytes. Its size is fixed by the vocabulary."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(m.vocab_size())
    for probe, want in (("a  b ", "▁a▁▁b▁"), ("ﬁ Å\tx", "▁ﬁ▁Å\tx"), ("", "")):  # no normaliser, spaces kept, a space put first
        if "".join(map(m.id_to_piece, m.encode(probe))).replace("<0x09>", "\t") != want:
            raise ValueError(f"{path}: its normaliser or its treatment of spaces is not the one that is built here")
    normal = [i for i in ids if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
    return {
        "pieces": [m.id_to_piece(i) for i in ids],
        "rank": {m.id_to_piece(i): (-m.get_score(i), i) for i in normal},
        "bytes": {int(m.id_to_piece(i)[3:5], 16): i for i in ids if m.is_byte(i)},
        "hidden": [i for i in ids if m.is_control(i)],
        "unknown": m.unk_id(),
    }


class PieceCodec:
    def __init__(self, model: dict):
        import ahocorasick

        self.rank, self.byte_ids = model["rank"], model["bytes"]
        self.pieces, self.unknown = model["pieces"], model["unknown"]
        chars = set("".join(self.rank))
        assert all(c in self.rank for c in chars), "a character of a piece is no piece"
        assert not any(SPACE in p.lstrip(SPACE) for p in self.rank), "a piece goes over a word's end"
        self.cut_lines = "\n" not in chars
        self.cut = re.compile(r"\n| *[^ \n]+| +" if self.cut_lines else r" *[^ ]+| +")
        self.chars = chars
        self.matches = ahocorasick.Automaton()
        self.fits: dict[int, bool] = {}
        self.made: dict[int, list] = {}
        for p, (_, i) in self.rank.items():
            if self.alone(i):
                self.matches.add_word(p, (i, len(p)))
        self.matches.make_automaton()
        self.units: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.text_of = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for b, i in self.byte_ids.items():
            self.text_of[i] = bytes([b])
        for i in model["hidden"]:
            self.text_of[i] = b""
        self.text_of[self.unknown] = " ⁇ ".encode()
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.digits = [str(i) for i in range(len(self.pieces))]

    def steps(self, t: int) -> list[tuple[float, str, str]]:
        """The merges that make a piece out of its characters, in order: rank, and the string's first and last part after it."""
        got = self.made.get(t)
        if got is None:
            got, parts = [], list(self.pieces[t])
            while True:
                best = None
                for i in range(len(parts) - 1):
                    r = self.rank.get(parts[i] + parts[i + 1])
                    if r is not None and (best is None or r[0] < best[0]):
                        best = (r[0], i)
                if best is None:
                    break
                i = best[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                got.append((best[0], parts[0], parts[-1]))
            self.made[t] = got
        return got

    def beside(self, a: int, b: int) -> bool:
        """Whether merging both pieces' characters gives just the two. Each side's merges keep their order, so both are run against each
        other by rank; it fails as soon as the parts at the seam would merge first (on the left of equals)."""
        key = a << 20 | b
        got = self.fits.get(key)
        if got is None:
            x, y, rank = self.steps(a), self.steps(b), self.rank
            u, v = self.pieces[a][-1], self.pieces[b][0]
            i = j = 0
            n, m = len(x), len(y)
            while True:
                seam = rank.get(u + v)
                left = x[i][0] if i < n else _NEVER
                right = y[j][0] if j < m else _NEVER
                if seam is not None and seam[0] < left and seam[0] <= right:
                    got = False
                    break
                if i == n and j == m:
                    got = True
                    break
                if left <= right:
                    u = x[i][2]
                    i += 1
                else:
                    v = y[j][1]
                    j += 1
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            self.fits[key] = got
        return got

    def alone(self, t: int) -> bool:
        """Whether merging a piece's characters gives the piece; others never stand in an encoding and are no matches."""
        steps = self.steps(t)
        return len(self.pieces[t]) == 1 or bool(steps) and steps[-1][1] == self.pieces[t]

    def _known(self, s: str) -> list[int]:
        """Ids of a string of known characters."""
        last, size, fits = [0] * (len(s) + 1), [0] * (len(s) + 1), self.fits
        for end, (t, n) in self.matches.iter(s):
            e = end + 1
            if size[e]:
                continue
            at = e - n
            if at:
                fit = fits.get(last[at] << 20 | t)
                if fit is None:
                    fit = self.beside(last[at], t)
                if not fit:
                    continue
            last[e], size[e] = t, n
        out, e = [], len(s)
        while e:
            out.append(last[e])
            e -= size[e]
        return out[::-1]

    def _unit(self, unit: str) -> tuple[int, ...]:
        """A unit that the young table lacks: out of the old one, or encoded. A full young table becomes the old one, so what is
        frequent stays while what came once goes."""
        if len(self.units) >= UNITS:
            self.old, self.units = self.units, {}
        kept = self.old.get(unit)
        if kept is not None:
            self.units[unit] = kept
            return kept
        s = unit.replace(" ", SPACE)
        if self.chars.issuperset(s):
            out = self._known(s)
        else:
            out, run = [], 0
            for i, c in enumerate(s):
                if c not in self.chars:
                    if i > run:
                        out += self._known(s[run:i])
                    out += [self.byte_ids.get(b, self.unknown) for b in c.encode("utf-8", "replace")]
                    run = i + 1
            if run < len(s):
                out += self._known(s[run:])
        out = tuple(out)
        if len(unit) <= UNIT_CHARS:
            self.units[unit] = out
        return out

    def forget(self) -> None:
        """Drops the tables of units, which later tasks of the worker would carry along."""
        self.units, self.old = {}, {}

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        units, unit = self.units, self._unit
        out = []
        for u in self.cut.findall(" " + text.replace(SPACE, " ")):
            out += units.get(u) or unit(u)
        return out

    def decode(self, ids) -> str:
        """Bytes that are no UTF-8 become one U+FFFD each; the leading space that encoding adds goes."""
        raw = b"".join(map(self.text_of.__getitem__, ids))
        try:
            out = raw.decode()
        except UnicodeDecodeError:
            parts, run = [], bytearray()

            def flush():
                at = 0
                while at < len(run):
                    for n in (4, 3, 2, 1):
                        try:
                            c = bytes(run[at : at + n]).decode()
                        except UnicodeDecodeError:
                            continue
                        if len(c) == 1:
                            parts.append(c)
                            at += n
                            break
                    else:
                        parts.append("�")
                        at += 1
                run.clear()

            for i in ids:
                if i in self.byte_of:
                    run.append(self.byte_of[i])
                else:
                    flush()
                    parts.append(self.text_of[i].decode())
            flush()
            out = "".join(parts)
        return out[1:] if out[:1] == " " and (len(ids) and self.pieces[ids[0]][:1] == SPACE) else out


def codec(model: dict) -> PieceCodec:
    return worker_cache(("pieces", len(model["pieces"]), hash(tuple(model["pieces"]))), lambda: PieceCodec(model))


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) and, if asked for, ids array<int>. path: the model's file, read by the
    driver; executors get its table as a broadcast, whose size the vocabulary fixes."""
    model = docs.sparkSession.sparkContext.broadcast(load_model(path or model_path()))

    def score(texts):
        c = codec(model.value)
        out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        for t in texts:
            ids = c.encode(t)
            if with_ids:
                out["ids"].append(np.array(ids, np.int32))
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(",".join(map(c.digits.__getitem__, ids)).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
        return out

    return per_text(docs, score, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids, rows=128, done=lambda: codec(model.value).forget())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), with_ids=False)
