"""Token counts under a unigram vocabulary by dynamic programming over a trie.

A text is cut into pre-tokens (a run of blanks and the word after it). The best
segmentation of a pre-token is the path of pieces with the largest summed score;
its forward score at a position depends only on the characters up to there. So
distinct pre-tokens go into a trie, each node holds the forward score and token
count of its prefix, computed once however many pre-tokens share it, and a
terminal's count is the count of its pre-token. Documents then add up terminal
counts. Nothing is shuffled: each task has a trie for the texts it reads.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_PRETOKEN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
TRIE_NODES = 600_000   # a full trie is started anew; results do not depend on it
_UNKNOWN_PENALTY = 10.0


def piece_scores(model_path: str) -> dict[str, float]:
    """Log-probabilities of the ordinary pieces of a sentencepiece file.

    The file orders merges by rank and has no probabilities; Zipf's law over the
    ranks gives them: a piece of rank r has weight 1 / r."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
             if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    norm = math.log(sum(1 / r for r in range(1, len(names) + 1)))
    return {p: -math.log(r) - norm for r, p in enumerate(names, 1)}


class Trie:
    """Pre-tokens with the forward scores of their prefixes.

    A character that no piece covers becomes its UTF-8 bytes (one token each) at
    ``_UNKNOWN_PENALTY`` below the least score per byte. Of equal sums the path
    whose last piece is shorter wins."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.byte = min(scores.values(), default=0.0) - _UNKNOWN_PENALTY
        # vocabulary as suffix sets: can a piece end with these characters?
        self.suffixes = {p[i:] for p in scores for i in range(len(p))}
        self.terminal: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        """Start a new trie. Terminal counts of the last one stay for look-up, so
        common pre-tokens are not computed again."""
        self.child: dict[int, int] = {}  # node * 2**21 + character -> node
        self.best: list[float] = [0.0]
        self.tokens: list[int] = [0]
        self.before, self.terminal = self.terminal, {}

    def _extend(self, path: list[int], word: str, end: int) -> int:
        """The node of ``word[:end]``; ``path`` holds the nodes of shorter prefixes."""
        scores, suffixes = self.scores, self.suffixes
        c = word[end - 1]
        if c in scores:
            top, n = self.best[path[end - 1]] + scores[c], self.tokens[path[end - 1]] + 1
        else:
            size = len(c.encode("utf-8", "replace"))
            top, n = self.best[path[end - 1]] + size * self.byte, self.tokens[path[end - 1]] + size
        for start in range(end - 2, max(-1, end - self.longest - 1), -1):
            piece = word[start:end]
            if piece not in suffixes:
                break
            s = scores.get(piece)
            if s is not None and self.best[path[start]] + s > top:
                top, n = self.best[path[start]] + s, self.tokens[path[start]] + 1
        self.best.append(top)
        self.tokens.append(n)
        return len(self.best) - 1

    def insert(self, word: str) -> int:
        """Store ``word`` and return its token count."""
        path = [0]
        for end in range(1, len(word) + 1):
            edge = (path[-1] << 21) + ord(word[end - 1])
            node = self.child.get(edge)
            if node is None:
                node = self.child[edge] = self._extend(path, word, end)
            path.append(node)
        self.terminal[word] = self.tokens[path[-1]]
        return self.terminal[word]

    def count(self, words: list[str]) -> int:
        if len(self.best) > TRIE_NODES or len(self.terminal) > TRIE_NODES:
            self.clear()
        for w in set(words).difference(self.terminal):
            n = self.before.get(w)
            if n is None:
                self.insert(w)
            else:
                self.terminal[w] = n
        return sum(map(self.terminal.__getitem__, words))


def pretokens(text: str) -> list[str]:
    """Blanks are written as the vocabulary's space mark; a text starts with one."""
    return _PRETOKEN.findall((" " + text).replace(" ", SPACE)) if text else []


_TRIES: dict[str, Trie] = {}


def _trie(model_path: str) -> Trie:
    if model_path not in _TRIES:
        _TRIES[model_path] = Trie(piece_scores(model_path))
    return _TRIES[model_path]


def token_counts(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_pretokens, n_tokens``.

    Null and empty texts have no pre-tokens and no tokens. Null and repeated ids
    are kept as they are. An empty table gives no rows; other columns are not
    read."""

    def run(batches):
        trie = _trie(model_path)
        for b in batches:
            pre, n = [], []
            for t in b.column(1):
                words = pretokens(t.as_py() or "")
                pre.append(len(words))
                n.append(trie.count(words))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(pre, np.int64)),
                                              pa.array(np.array(n, np.int64))], ["doc_id", "n_pretokens", "n_tokens"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long"))
