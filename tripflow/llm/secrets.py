"""Secret scans by assignment-aware lexing.

Every text is read whole, in two ways whose spans are put together:

* the fixed patterns of assignments, access keys and hex runs (kinds ``assign``, ``access``, ``hex``);
* a lexer for the assignments of source code and configuration: ``name = value``, ``name: value``,
  ``name := value``, ``name += value``, ``"name" => value``, with quoted or bare names, quoted subscripts
  (``config["name"] = value``), types of any depth (``name: A[B[str]] = value``, ``name string = value``) and several
  targets; YAML blocks, XML elements and attribute pairs, ``#define``, ``define('NAME', '...')``, setters.  A value is
  an expression of string literals (adjacent, triple-quoted, in brackets), names and calls, joined by ``+`` or ``or``.
  Of a call, its arguments count, of one that looks something up (``getenv``) only a default; a name that is
  called is no value, and a bare word is one only as a whole setting of a configuration line.  Constants
  propagate: a name
  stands for the literals last assigned to it, through any number of further names.  A literal that
  ends up under a sensitive name is scored by that name and by its own make-up (length, mix of
  letters and digits, entropy; white space and placeholder words in it lower the score, a value whose literals
  are all placeholders has none; one rule for all lengths), and from ``THRESHOLD`` on its span is reported as
  kind ``literal``, unless a pattern's span holds it already.

Offsets are code points, ends exclusive.  Names and literals of any length are read in linear time
(possessive patterns).  Null texts count as empty; every row gives one row, repeated rows repeated
ones; an empty table gives none.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import map_texts, text_of

KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 0.7
DOUBT = 0.1
#: Shorter values are no secrets.
SHORTEST = 8
#: Lengths and counts beyond this are all alike to the score.
MANY = 1 << 40

# The patterns that the task names.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_MIN, ACCESS_MIN = 8, 16

_SUBSCRIPTS = r"""(?:\[[ \t]*+(?:"[A-Za-z_$][\w$.-]*+"|'[A-Za-z_$][\w$.-]*+')[ \t]*+\])"""
#: A name, as it stands before an assignment (with its subscripts), and the assignment sign.
_NAME = re.compile(rf"""(?<![\w$.-])["'`]?([A-Za-z_$][\w$.-]*+(?:{_SUBSCRIPTS}(?:\.[\w$.-]++)?+)*+)["'`]?+(?:[ \t]*+\])?+"""
                   r"""(?:[ \t]++(?:string|\[\]byte)[ \t]*+=(?![=~>])|[ \t]*+(:=|=>|(?:\|\||\?\?|[?+|])?+=(?![=~])|[?!]?+:(?![:/])))[ \t]*+""")
#: A type after a colon: names with brackets of any depth (``Brackets`` skips them), references, alternatives.  It is
#: one if white space and ``=``, or ``=`` and a quote, come after it.
_ATOM = re.compile(r"""(?:[&*]++(?:'\w++[ \t]++)?+(?:(?:const|mut)[ \t]++)?+)?+[A-Za-z_$][\w$]*+(?:(?:\.|::)[A-Za-z_$][\w$]*+)*+""")
_QUOTED_TYPE = re.compile(r""""[^"\n]*+"|'[^'\n]*+'""")
_OR_TYPE = re.compile(r"[ \t]*+[|&][ \t]*+")
_TYPED = re.compile(r"""(?:[ \t]++(?==)|(?==[ \t]*+(?:[rbuf]{0,2}["'`])))=(?![=~>])[ \t]*+""")
_BRACKET = re.compile(r"[][<>\n=;]")
_TERM = re.compile(rf"""(?:[rbuf]{{0,2}}\"{{3}}((?:[^"\\]|\\[\s\S]|"(?!""))*+)\"{{3}}|[rbuf]{{0,2}}'{{3}}((?:[^'\\]|\\[\s\S]|'(?!''))*+)'{{3}}"""
                   rf"""|[rbuf]{{0,2}}"((?:[^"\\\n]|\\.)*+)"|[rbuf]{{0,2}}'((?:[^'\\\n]|\\.)*+)'|`((?:[^`\\\n]|\\.)*+)`"""
                   rf"""|([A-Za-z_$][\w$]*+(?:\.[A-Za-z_$][\w$]*+)*+)(?![\w$/=~@%-])((?:{_SUBSCRIPTS}(?:\.[A-Za-z_$][\w$]*+)*+)*+)|([\w+/.~!@%^&*-]++={{0,2}}))""")
#: The groups of a term: quoted literals, a name, its subscripts, a bare value.
_QUOTED, _REF, _REF_SUBSCRIPTS, _BARE = (1, 2, 3, 4, 5), 6, 7, 8
_KEY = re.compile(r"""\[[ \t]*+["']([^"']*+)["'][ \t]*+\]""")
#: What joins two terms of a value: concatenation and "this or else that".
_JOIN = re.compile(r"\s*+(?:\+(?![+=])|\|\||\?\?|\?:|or\b)\s*+|[ \t]++\.[ \t]++")
#: What may stand between two literals that are one: white space, inside brackets also across lines.
_BESIDE = re.compile(r"""(?:[ \t]|\\\n)*+(?=[rbuf]{0,2}["'])""")
_BESIDE_INSIDE = re.compile(r"""(?:\s|\\\n)*+(?=[rbuf]{0,2}["'])""")
_CALL = re.compile(r"[ \t]*+\(")
_SPACE = re.compile(r"\s*+")
#: Calls on a value that leave it the same secret: ``"...".encode("utf-8")``.
_METHOD = re.compile(r"""(?:\.[A-Za-z_]\w*+\([^()\n]*+\))++""")
#: Calls whose first argument says where the value is, not what it is; only a default after it may be a value.
_LOOKUP = re.compile(r"(?i)_*+(?:get|load|read|open|fetch|find|look|env|require|import|prompt|input|ask|param|arg|resolve|parse|query|select|compile|match|search|test|print|log|warn|info|debug|error)")
#: What may stand on a line before a setting of a configuration file, and after its bare value.
_BEFORE_SETTING = re.compile(r"""[ \t]*+(?:(?:export|set|ENV|ARG)[ \t]++|-[ \t]++)?+["'`]?""")
_AFTER_SETTING = re.compile(r"[ \t]*+(?:(?<=[ \t])#[^\n]*+)?+\r?(?:\n|\Z)")
_BLOCK = re.compile(r"[|>][-+0-9]{0,2}[ \t]*+\n")
_BLOCK_LINE = re.compile(r"([ \t]*+)([^\n]*+)(?:\n|\Z)")
_TEXT = r"""(?:"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)')"""
#: Other forms that pair a name with a literal: XML elements and ``key``/``value`` attributes, ``#define``,
#: ``define('NAME', '...')`` and other calls of a name and a value, setters.
_FORMS = re.compile(rf"""<([A-Za-z_][\w.:-]*+)(?:[ \t\n][^<>]*+)?+>([^<>]++)</|\b(?:key|name)[ \t]*+=[ \t]*+["']([A-Za-z_][\w.:-]*+)["']\s++value[ \t]*+=[ \t]*+{_TEXT}"""
                    rf"""|\#[ \t]*+define[ \t]++(\w++)[ \t]++{_TEXT}|\b(?:define|putenv|set\w*+|put\w*+|add\w*+|insert|append)\([ \t]*+["']([A-Za-z_][\w.-]*+)["'][ \t]*+,[ \t]*+{_TEXT}"""
                    rf"""|\b(?:set|with)_?([A-Za-z]\w*+)\([ \t]*+{_TEXT}[ \t]*+\)""")
#: Several targets of one assignment, at a line's start.
_TARGETS = re.compile(r"(?m)^[ \t]*+(\(?[ \t]*+[A-Za-z_$][\w$.]*+(?:[ \t]*+,[ \t]*+[A-Za-z_$][\w$.]*+)++)[ \t]*+\)?[ \t]*+=(?![=~>])[ \t]*+\(?[ \t]*+")
_TARGET = re.compile(r"[A-Za-z_$][\w$.]*+")
_COMMA = re.compile(r"[ \t]*+,[ \t]*+")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_MARK = re.compile(r"(?i)undefined|change.?me|example|placeholder|your[_-]|dummy|sample|redacted|not.?set|x{4,}|\*{3,}|<|>|\$\{|\{\{|%\(")
#: What a value that is a placeholder as a whole is made of, if it has such a mark; longer words first.
_FILLER = re.compile(r"""(?i)(?:<[^<>]*+>|\$\{[^{}]*+\}|\{\{[^{}]*+\}\}|%\([^()]*+\)[sd]?|placeholder|undefined|credentials?|passphrase|connection|passwords?|redacted
    |example|changed|change|replace|private|secrets?|string|sample|access|client|insert|passwd|tokens?|values?|please|dummy|enter|login|admin|users?|names?|email|https?
    |keys?|your|with|here|this|that|test|auth|pass|todo|must|data|code|text|foo|bar|baz|app|api|pwd|set|not|put|the|for|and|org|com|net|xyz|123|abc
    |x{3,}|my|me|id|db|an?|is|be|to|of|in|it|on|[\W_]|\d{1,4}(?!\d))++""", re.VERBOSE)

#: How much a name says that its value is secret, by the parts of the name.
SENSITIVE = {"password": 0.6, "passwd": 0.6, "passphrase": 0.6, "pwd": 0.5, "secret": 0.6, "token": 0.5, "apikey": 0.6,
             "credential": 0.5, "credentials": 0.5, "auth": 0.4, "bearer": 0.5, "signature": 0.3}
SENSITIVE_PAIRS = {("api", "key"): 0.6, ("access", "key"): 0.6, ("private", "key"): 0.6, ("secret", "key"): 0.6,
                   ("encryption", "key"): 0.5, ("signing", "key"): 0.5, ("client", "secret"): 0.6, ("connection", "string"): 0.4}


def name_score(name: str) -> float:
    parts = [p.lower() for p in _PARTS.findall(name)]
    best = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    return max([best, *(SENSITIVE_PAIRS.get(p, 0.0) for p in zip(parts, parts[1:]))])


def made_up(n: int, counts: Counter[str]) -> float:
    """The score of a value's make-up: a mix of letters and digits, entropy, length."""
    total = counts.total()
    entropy = -sum(k / total * math.log2(k / total) for k in counts.values())
    mixed = any(c.isdigit() for c in counts) and any(c.isalpha() for c in counts)
    return 0.15 * mixed + 0.15 * (entropy >= 2.8) + 0.1 * (n >= 16)


def judged(n: int, counts: Counter[str], marked: bool, filler: bool) -> float:
    """The score of a make-up, less ``DOUBT`` for white space or a placeholder's mark inside; a value
    with these and nothing but a placeholder's words is one."""
    doubtful = marked or any(c.isspace() for c in counts)
    return -1.0 if doubtful and filler else made_up(n, counts) - DOUBT * doubtful


class Value:
    """What a name stands for: spans and other values in order, shared and never copied.  ``n`` is its
    length; ``uses``, how many names and values hold it; ``made``, its characters' counts, once asked for, and
    ``marked``, if one of its literals has a placeholder's mark, ``filler``, if all are made of such words."""

    __slots__ = ("parts", "n", "uses", "made", "marked", "filler", "told")

    def __init__(self, parts: list[tuple[int, int] | Value]) -> None:
        self.parts, self.uses, self.made, self.marked, self.filler, self.told = parts, 0, None, False, False, False
        self.n = min(MANY, sum(p.n if isinstance(p, Value) else p[1] - p[0] for p in parts))
        for p in parts:
            if isinstance(p, Value):
                p.uses += 1

    def spans(self, again: bool) -> Iterator[tuple[int, int]]:
        """The spans in order; without ``again`` none of a value that has told its spans before."""
        stack: list[tuple[int, int] | Value] = [self]
        while stack:
            if not isinstance(p := stack.pop(), Value):
                yield p
            elif again or not p.told:
                p.told |= not again
                stack += reversed(p.parts)

    def counts(self, text: str) -> Counter[str]:
        """How often the value has each character; a value that only this one holds gives its own up."""
        stack = [self]
        while stack:
            v = stack[-1]
            if v.made is None and (open_ := [p for p in v.parts if isinstance(p, Value) and p.made is None]):
                stack += open_
                continue
            stack.pop()
            if v.made is not None:
                continue
            inner = [p for p in v.parts if isinstance(p, Value)]
            own = next((p for p in inner if p.uses == 1), None)
            made = own.made if own else Counter()
            for p in v.parts:
                if p is not own:
                    made.update(p.made if isinstance(p, Value) else text[p[0]:p[1]])
            if own:
                own.made = None
            if max(made.values(), default=0) > MANY:
                top = max(made.values())
                made = Counter({c: max(1, k * MANY // top) for c, k in made.items()})
            v.made = made
            v.marked = any(p.marked if isinstance(p, Value) else _MARK.search(text, *p) for p in v.parts)
            v.filler = all(p.filler if isinstance(p, Value) else _FILLER.fullmatch(text, *p) for p in v.parts)
        return self.made

    def score(self, text: str) -> float:
        if self.n < SHORTEST:
            return -1.0
        counts = self.counts(text)
        return judged(self.n, counts, self.marked, self.filler)


def patterns(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def path(name: str) -> str:
    """A name with subscripts as one with dots: ``config["db"]`` is ``config.db``."""
    return _KEY.sub(r".\1", name) if "[" in name else name


class Brackets:
    """Where each bracket of a text closes; types hold neither line breaks nor ``=`` and ``;``.  Found in one go over
    the text, once a type asks."""

    def __init__(self, text: str) -> None:
        self.text, self.ends = text, None

    def end(self, at: int) -> int | None:
        if self.ends is None:
            self.ends, open_ = {}, []
            for m in _BRACKET.finditer(self.text):
                c = m[0]
                if c in "[<":
                    open_.append((c, m.start()))
                elif c in "]>" and open_ and open_[-1][0] == ("[" if c == "]" else "<"):
                    self.ends[open_.pop()[1]] = m.end()
                else:
                    open_.clear()
        return self.ends.get(at)

    def after_type(self, at: int) -> int | None:
        """Where the value starts, if a type and an assignment sign stand at ``at``."""
        text = self.text
        while True:
            if quoted := _QUOTED_TYPE.match(text, at):
                at = quoted.end()
                break
            if (atom := _ATOM.match(text, at)) is None:
                return None
            at = atom.end()
            while text[at:at + 1] in ("[", "<"):
                if (end := self.end(at)) is None:
                    return None
                at = end
            at += text[at:at + 1] in ("?", "!")
            if (more := _OR_TYPE.match(text, at)) is None:
                break
            at = more.end()
        m = _TYPED.match(text, at)
        return m.end() if m else None


Parts = list["tuple[int, int] | Value"]


def expression(text: str, at: int, known: dict[str, Value]) -> tuple[Parts, tuple[int, int] | None, int]:
    """What the expression at ``at`` is made of, and where it ends: literals and known names that ``+``, ``or`` or
    nothing joins, in brackets, and in calls (their arguments; of a call that looks something up, only a
    default).  A name that is called is no value.  A bare word that stands alone comes apart."""
    parts: Parts = []
    frames: list[tuple[str, int, int]] = []  # of each open bracket: kind, first part, first part of the last argument
    bare, terms = None, 0
    while True:
        if frames:
            at = _SPACE.match(text, at).end()
        quoted = None
        if text.startswith("(", at):
            frames.append(("group", len(parts), len(parts)))
            at += 1
            continue
        closing = bool(frames) and text.startswith(")", at)
        if not closing:
            if (t := _TERM.match(text, at)) is None:
                break
            terms += 1
            at = t.end()
            quoted = next((g for g in _QUOTED if t[g] is not None), None)
            if quoted:
                parts.append(t.span(quoted))
            elif t[_REF] is not None:
                ref = path(t[_REF] + t[_REF_SUBSCRIPTS])
                if call := _CALL.match(text, at):
                    owner, _, last = ref.rpartition(".")
                    kind = "lookup" if _LOOKUP.match(last) else "call"
                    if owner in known:
                        parts.append(known[owner])
                        kind = "method"
                    frames.append((kind, len(parts), len(parts)))
                    at = call.end()
                    continue
                if (value := known.get(ref) or known.get(t[_REF])) is not None:
                    parts.append(value)
                elif terms == 1 and not frames:
                    bare = t.span(_REF)
            elif terms == 1 and not frames and not text.startswith(("(", "["), at):
                parts.append(t.span(_BARE))
        while True:  # after a term: closing brackets, then what joins it to a next one
            if m := _METHOD.match(text, at):
                at = m.end()
            end = _SPACE.match(text, at).end()
            if frames and text.startswith(")", end):
                kind, first, last = frames.pop()
                if kind == "lookup":
                    del parts[first:last if last > first or text[end - 1] == "," else len(parts)]
                elif kind == "method":
                    del parts[first:]
                at, quoted = end + 1, None
                continue
            break
        if frames and text.startswith(",", end):
            kind, first, _ = frames[-1]
            if kind == "lookup":  # what comes before a default is no value
                del parts[first:]
                frames[-1] = ("default", first, first)
            at = end + 1
            continue
        joined = _JOIN.match(text, at) or (quoted and (_BESIDE_INSIDE if frames else _BESIDE).match(text, at))
        if not joined:
            break
        bare, at = None, joined.end()
    for kind, first, _ in reversed(frames):  # cut short
        if kind in ("lookup", "method"):
            del parts[first:]
    return parts, bare, at


def block(text: str, at: int, indent: int) -> tuple[Parts, int]:
    """The lines of a YAML block, without their indentation, and its end."""
    parts: Parts = []
    while at < len(text):
        m = _BLOCK_LINE.match(text, at)
        if m[2].strip():
            if len(m[1]) <= indent:
                break
            parts.append((m.start(2), m.start(2) + len(m[2].rstrip())))
        at = m.end()
    return parts, at


def literals(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the literals that reach a sensitive name."""
    known: dict[str, Value] = {}
    found: set[tuple[int, int]] = set()
    brackets = Brackets(text)

    def assign(name: str, parts: Parts, more: bool = False) -> None:
        old = known.pop(name, None)
        # Without empty parts, a value has no more parts than characters.
        parts = [p for p in parts if (p.n if isinstance(p, Value) else p[1] > p[0])]
        if more and old is not None:
            parts = [old, *parts]
        if parts:
            value = parts[0] if len(parts) == 1 and isinstance(parts[0], Value) else Value(parts)
            known[name] = value
            value.uses += 1
            weight = name_score(name)
            if weight and round(weight + value.score(text), 6) >= THRESHOLD:
                found.update(value.spans(again=False))
        if old is not None:
            old.uses -= 1

    forms = [(m.start(), m) for m in _FORMS.finditer(text)] + [(m.start(1), m) for m in _TARGETS.finditer(text)]
    forms.sort(key=lambda f: f[0], reverse=True)
    done: set[int] = set()  # the names before a sign that a form has read already

    def read_forms(upto: int) -> None:
        while forms and forms[-1][0] <= upto:
            m = forms.pop()[1]
            if m.re is _TARGETS:
                names, at, values = list(_TARGET.finditer(text, *m.span(1))), m.end(), []
                while True:
                    parts, bare, at = expression(text, at, known)
                    values.append(parts)
                    if (comma := _COMMA.match(text, at)) is None:
                        break
                    at = comma.end()
                if len(names) == len(values):
                    done.add(names[-1].start())
                    for name, parts in zip(names, values):
                        assign(name[0], parts)
                continue
            name, *_, value = (g for g in range(1, len(m.groups()) + 1) if m[g] is not None)
            assign(m[name], [m.span(value)])

    at, line = 0, 0
    while m := _NAME.search(text, at):
        start = m.start(1)
        line = text.rfind("\n", line, start) + 1 or line
        read_forms(start)
        name, sign, at = path(m[1]), m[2] or "", m.end()
        if sign.endswith(":"):
            typed = brackets.after_type(at)
            if typed is not None:
                sign, at = "typed", typed
            elif sign != ":":
                continue
        if start in done:
            continue
        setting = start - line <= 64 and _BEFORE_SETTING.fullmatch(text, line, start)
        if sign == ":" and setting and (m2 := _BLOCK.match(text, at)) and name_score(name):
            parts, at = block(text, m2.end(), len(text[line:start]) - len(text[line:start].lstrip(" \t")))
            assign(name, parts)
            continue
        parts, bare, end = expression(text, at, known)
        if bare and setting and _AFTER_SETTING.match(text, end):
            tight = sign == "=" and text[at - 1] == "=" and text[m.start(2) - 1] not in " \t"
            if tight or any(c.isdigit() for c in text[bare[0]:bare[1]]):
                parts = [bare]
        assign(name, parts, more=sign == "+=")
    read_forms(len(text))
    return [(a, 3, b) for a, b in sorted(found)]


def spans_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(the patterns' spans, those and the lexer's), each by start, then kind."""
    base = patterns(text)
    more = literals(text) if any(c in text for c in "=:<(#") else []
    starts = [a for a, _, _ in base]
    ends = list(accumulate((b for _, _, b in base), max))  # the furthest end so far
    free = [s for s in more if not (k := bisect_right(starts, s[0])) or ends[k - 1] < s[2]]
    return base, sorted([*base, *free])


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_literal, base, spans) of every row; ``base`` and
    ``spans`` are lists of kind:start:end."""

    def of(text: str) -> tuple:
        base, spans = spans_of(text)
        kinds = Counter(k for _, k, _ in spans)
        return (*(kinds[k] for k in range(4)), written(base), written(spans))

    d = df.select(F.col(id_col), text_of(text_col).alias("whole_text"))
    return map_texts(d, [id_col], lambda: of, "n_assign long, n_access long, n_hex long, n_literal long, base string, spans string", "whole_text")
