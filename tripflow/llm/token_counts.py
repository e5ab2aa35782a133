"""Token counts by a linear longest-match automaton.

Greedy word pieces: at each point of a word the longest piece that fits is taken (the first from
the word-initial pieces, later ones from the continuing pieces).  The vocabulary is a trie; where a
node cannot go on, its failure link leads to the node that spells the rest after the greedy pieces
of what was read are popped off, and how many pieces that pops is precomputed.  So a word's count
needs one step per character and one hop per popped piece, and no piece is ever built.

A word that pieces cannot spell counts as one unknown token.  Words are runs of anything but white
space; a word's count is kept in a bounded cache.  Null and empty texts have no tokens; every row
gives one row, repeated rows repeated ones; an empty table gives none.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import WORD, map_texts, text_of

CACHE = 200_000


def pieces_of_model(path: str, mark: str = "▁") -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(word-initial pieces, continuing pieces) of a piece model: those with and without the mark."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    plain = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    first = tuple(p[1:] for p in plain if p.startswith(mark) and p.strip(mark))
    return first, tuple(p for p in plain if mark not in p)


class Automaton:
    """Trie with failure links and popped-piece counts."""

    def __init__(self, first: Iterable[str], more: Iterable[str]) -> None:
        self.goto: list[dict[str, int]] = [{}, {}]  # node 0 begins a word, node 1 continues one
        whole: list[bool] = [False, False]
        for root, pieces in ((0, first), (1, more)):
            for piece in pieces:
                node = root
                for c in piece:
                    nxt = self.goto[node].get(c)
                    if nxt is None:
                        nxt = len(self.goto)
                        self.goto.append({})
                        whole.append(False)
                        self.goto[node][c] = nxt
                    node = nxt
                if piece:
                    whole[node] = True
        # fail[v]: where to go on when v cannot; -1: nowhere.  pops[v]: pieces popped on the way.
        self.fail, self.pops = [-1] * len(self.goto), [0] * len(self.goto)
        queue = deque([0, 1])
        while queue:
            v = queue.popleft()
            for c, u in self.goto[v].items():
                queue.append(u)
                if whole[u]:
                    self.fail[u], self.pops[u] = 1, 1
                    continue
                at, n = self.fail[v], self.pops[v]
                while at >= 0 and c not in self.goto[at]:
                    n, at = n + self.pops[at], self.fail[at]
                if at >= 0:
                    self.fail[u], self.pops[u] = self.goto[at][c], n

    def count(self, word: str) -> int:
        """Pieces of a word; 0 if pieces cannot spell it."""
        goto, fail, pops = self.goto, self.fail, self.pops
        node, n = 0, 0
        for c in word:
            nxt = goto[node].get(c)
            while nxt is None:
                n += pops[node]
                node = fail[node]
                if node < 0:
                    return 0
                nxt = goto[node].get(c)
            node = nxt
        while node != 1:  # the end of the word: pop what is left
            n += pops[node]
            node = fail[node]
            if node < 0:
                return 0
        return n


class Counter:
    """Word counts with a bounded cache; 0 in it stands for an unknown word."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton, self.cache, self.find = automaton, {}, re.compile(WORD).findall

    def text(self, text: str) -> tuple[int, int, int]:
        """(words, tokens, unknown words)"""
        words, cache = self.find(text), self.cache
        tokens = unknown = 0
        for w in words:
            n = cache.get(w)
            if n is None:
                n = self.automaton.count(w)
                if len(w) <= 64:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[w] = n
            if n:
                tokens += n
            else:
                unknown += 1
        return len(words), tokens + unknown, unknown


_COUNTERS: dict[int, Counter] = {}


def token_counts(df: DataFrame, first: tuple[str, ...], more: tuple[str, ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) of every row.  The vocabulary is broadcast: it is as
    large as the model, whatever the data."""
    shared = df.sparkSession.sparkContext.broadcast((first, more))
    key = hash((first, more))

    def make() -> Callable[[str], tuple[int, int, int]]:
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = Counter(Automaton(*shared.value))
        return _COUNTERS[key].text

    d = df.select(F.col(id_col), text_of(text_col).alias("whole_text"))
    return map_texts(d, [id_col], make, "n_words long, n_tokens long, n_unknown long", "whole_text")
