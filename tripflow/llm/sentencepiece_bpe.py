"""SentencePiece encoding and decoding of a merge-type model, linear in the text.

The model's merges always join the neighbours whose joined piece ranks highest, leftmost first.
What that gives for a text's prefix ends in one certain piece: of the pieces that are a suffix of
the prefix, the one that the encoding of what is before it can stand beside.  So one pass of the
pieces' automaton over the text, testing each match against the last piece of the prefix before
it, fills a table of every prefix's last piece; the ids are read off it backwards.

**Pair compatibility.** Two pieces can stand side by side if, while both are taken apart in the
reverse order of their merges, no merge over the border would have come first.  Results are kept.

**Segments.** Text is escaped as the library does (space to U+2581, one put before the text), and no
piece has a U+2581 after another character, so segments that begin at a U+2581 are encoded on their
own and kept in a bounded cache.  Runs of U+2581 rank equal and last; they merge leftmost first
among themselves.  A character without a piece gives its UTF-8 bytes' pieces.

The vocabulary comes from the model file on the driver (a parameter) and is broadcast: it is as
large as the model, whatever the data.  Null texts count as empty and give the begin and end ids;
every row gives one row; repeated rows give repeated rows; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Callable
from dataclasses import dataclass

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import map_texts, text_of

SPACE = "▁"
CACHE = 300_000
_ALONE = 1 << 60


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id, their ranks (0: merged first; none: a single character, a byte or a control)."""
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    control_ids: tuple[int, ...]
    unknown: int
    bos: int
    eos: int


def load(path: str) -> Vocabulary:
    """The vocabulary of a model file (driver only)."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    byte_ids = [i for i in range(n) if sp.is_byte(i)]
    if len(byte_ids) != 256:
        raise ValueError("the model needs the 256 byte pieces")
    byte_ids.sort(key=lambda i: int(sp.id_to_piece(i)[3:-1], 16))
    return Vocabulary(tuple(sp.id_to_piece(i) for i in range(n)), tuple(sp.get_score(i) for i in range(n)), tuple(byte_ids),
                      tuple(i for i in range(n) if sp.is_control(i)), sp.unk_id(), sp.bos_id(), sp.eos_id())


class _Segments(dict):
    """Segments' ids as bytes, in two generations of bounded size: what is asked for again moves to
    the young one, and when that is full the old one goes.  Long segments are not kept."""

    def __init__(self, codec: Codec) -> None:
        self.codec, self.old = codec, {}

    def __missing__(self, segment: str) -> bytes:
        ids = self.old.get(segment)
        if ids is None:
            ids = array("I", self.codec._segment(segment)).tobytes()
        if len(segment) <= 64:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[segment] = ids
        return ids


class Codec:
    """Encoder and decoder of a vocabulary."""

    def __init__(self, v: Vocabulary) -> None:
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise NotImplementedError("ids are written as little-endian 32-bit integers")
        self.v = v
        special = {*v.byte_ids, *v.control_ids, v.unknown}
        self.ids = {p: i for i, p in enumerate(v.pieces) if i not in special}
        merged = sorted((p for p in self.ids if len(p) > 1 and p.strip(SPACE)), key=lambda p: (-v.scores[self.ids[p]], self.ids[p]))
        if any(SPACE in p[1:] for p in merged):
            raise ValueError("pieces that go on over a space are not supported")
        self.rank = {p: k for k, p in enumerate(merged)}
        self.runs = {len(p) for p in self.ids if not p.strip(SPACE)}
        self.parts: dict[int, tuple[int, int]] = {}
        self.order: dict[int, int] = {}
        auto = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if len(p) == 1:
                self.order[i] = -1
                auto.add_word(p, (1, i))
        for p in merged:  # a piece that its own merges do not lead to never comes up
            split = self._last_merge(p)
            if split is not None:
                left, right = self.ids[split[0]], self.ids[split[1]]
                if max(self.order.get(left, _ALONE), self.order.get(right, _ALONE)) >= self.rank[p]:
                    raise ValueError(f"piece {p!r} ranks before one of its parts")
                self.parts[self.ids[p]], self.order[self.ids[p]] = (left, right), self.rank[p]
                auto.add_word(p, (len(p), self.ids[p]))
        auto.make_automaton()
        self.auto = auto
        self.joined = {lr: i for i, lr in self.parts.items()}
        self.fits: dict[int, bool] = {}
        self.segments = _Segments(self)
        self.known = re.compile("[" + re.escape("".join(p for p in self.ids if len(p) == 1)) + "]*")
        self.head = np.array([v.bos], dtype="<u4").tobytes()
        self.tail = np.array([v.eos], dtype="<u4").tobytes()
        byte = {i: b for b, i in enumerate(v.byte_ids)}
        self.byte = byte
        self.surface = [("" if i in v.control_ids else p.replace(SPACE, " ")) for i, p in enumerate(v.pieces)]
        self.surface[v.unknown] = " ⁇ "
        for b, i in enumerate(v.byte_ids[:128]):
            self.surface[i] = chr(b)
        self.is_byte = np.zeros(len(v.pieces), dtype=bool)
        self.is_byte[list(v.byte_ids)] = True
        #: A byte of ASCII is a character wherever it stands; only others need their neighbours.
        self.is_high = np.zeros(len(v.pieces), dtype=bool)
        self.is_high[list(v.byte_ids[128:])] = True

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the merges of ``piece``'s own characters join last."""
        parts = list(piece)
        while len(parts) > 2:
            best = min(((self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank), default=None)
            if best is None:
                return None
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return (parts[0], parts[1]) if all(p in self.ids for p in parts) else None

    def fit(self, left: int, right: int) -> bool:
        """Whether the merges can leave ``left`` and ``right`` side by side.

        Both are taken apart, latest merge first, down to the border.  The pieces that face each
        other there at a time stood side by side until the next merge on either side: a joint
        piece that ranks before that merge would have been made instead.  At equal rank the merge
        further left comes first: inside ``left`` before the joint, the joint before ``right``'s.
        """
        a, b, limit = left, right, (_ALONE, 1)
        while True:
            joint = self.joined.get((a, b))
            if joint is not None and (self.order[joint], 0) < limit:
                return False
            oa, ob = self.order[a], self.order[b]
            if oa < 0 and ob < 0:
                return True
            if ob >= oa:  # of equal ranks, the right one was merged later
                limit, b = (ob, 1), self.parts[b][0]
            else:
                limit, a = (oa, -1), self.parts[a][1]

    def _known_ids(self, text: str) -> list[int] | None:
        """The ids of a text whose only U+2581 is its first; None if a character has no piece."""
        last, sizes, fits, found, ends = [0] * len(text), [0] * len(text), self.fits, -1, 0
        for end, (n, piece) in self.auto.iter(text):  # of one end, the longest match first
            if end == found:
                continue
            if n <= end:
                if not sizes[end - n]:  # an end without a piece: every known character is one
                    return None
                before = last[end - n]
                pair = before << 32 | piece
                fit = fits.get(pair)
                if fit is None:
                    if len(fits) >= CACHE:
                        fits.clear()
                    fit = fits[pair] = self.fit(before, piece)
                if not fit:
                    continue
            last[end], sizes[end], found, ends = piece, n, end, ends + 1
        if ends < len(text):
            return None
        out, i = [], len(text) - 1
        while i >= 0:
            out.append(last[i])
            i -= sizes[i]
        out.reverse()
        return out

    def _run_ids(self, n: int) -> list[int]:
        """The ids of ``n`` U+2581: neighbours merge leftmost first."""
        stack: list[int] = []
        for _ in range(n):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.runs:
                top = stack.pop()
                stack[-1] += top
        return [self.ids[SPACE * k] for k in stack]

    def _segment(self, seg: str) -> list[int]:
        """The ids of some U+2581 and what follows them up to the next."""
        if seg[1:2] != SPACE and len(seg) > 1:
            ids = self._known_ids(seg)
            if ids is not None:
                return ids
        body = seg.lstrip(SPACE)
        spaces = len(seg) - len(body)
        out: list[int] = []
        first = True
        at = 0
        while at < len(body):
            end = self.known.match(body, at).end()
            if end > at:
                if first and spaces:
                    ids = self._known_ids(SPACE + body[at:end])
                    # A space that stays alone joins the run before it.
                    alone = ids[0] == self.ids[SPACE]
                    out += self._run_ids(spaces - (not alone)) + (ids[1:] if alone else ids)
                else:
                    out += self._known_ids(body[at:end])
            else:
                end = at + 1
                if first:
                    out += self._run_ids(spaces)
                out += [self.v.byte_ids[x] for x in body[at].encode("utf-8")]
            first, at = False, end
        return out if body else self._run_ids(spaces)

    def encode(self, text: str) -> bytes:
        """All ids, begin and end included, as little-endian unsigned 32-bit integers."""
        if not text:
            return self.head + self.tail
        escaped = SPACE + text.replace(" ", SPACE)
        return self.head + b"".join(map(self.segments.__getitem__, _SEGMENT.findall(escaped))) + self.tail

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, as the library decodes them: control ids are nothing, byte ids are the
        text they spell (each byte that spells none is U+FFFD), the first space is taken off."""
        high = self.is_high[ids]
        surface = self.surface
        if not high.any():
            text = "".join([surface[i] for i in ids.tolist()])
        else:
            cuts = np.flatnonzero(np.diff(high)) + 1
            parts = []
            for part in np.split(ids, cuts):
                if self.is_high[part[0]]:
                    parts.append(_spelled(bytes([self.byte[i] for i in part.tolist()])))
                else:
                    parts.append("".join([surface[i] for i in part.tolist()]))
            text = "".join(parts)
        first = ids[~np.isin(ids, self.v.control_ids)][:1]
        return text[1:] if len(first) and text.startswith(" ") and not self.is_byte[first[0]] and first[0] != self.v.unknown else text


#: A segment: U+2581s and what follows up to the next; text always starts with one.
_SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*")


def _spelled(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[at:at + n].decode("utf-8"))
                    break
                except UnicodeDecodeError:
                    continue
            else:
                n = 1
                out.append("�")
            at += n
        return "".join(out)


_CODECS: dict[int, Codec] = {}


def _codec(vocabulary: Vocabulary) -> Codec:
    """The codec of a broadcast vocabulary: built once in each Python worker."""
    key = hash((vocabulary.pieces, vocabulary.scores))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocabulary)
    return _CODECS[key]


def encoded(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row; without ``ids``, digests of the two instead."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def make() -> Callable[[str], tuple]:
        codec = _codec(shared.value)

        def of(text: str) -> tuple:
            raw = codec.encode(text)
            numbers = np.frombuffer(raw, dtype="<u4")
            decoded = codec.decode(numbers)
            if ids:
                return len(numbers), numbers.astype(np.int32), decoded
            return len(numbers), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode("utf-8")).hexdigest()

        return of

    d = df.select(F.col(id_col), text_of(text_col).alias("whole_text"))
    ddl = "n_tokens long, ids array<int>, decoded string" if ids else "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(d, [id_col], make, ddl, "whole_text")
