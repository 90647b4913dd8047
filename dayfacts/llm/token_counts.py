"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

The distinct pre-tokens of a task go into a trie, batch after batch: a pre-token takes the forward
scores of the prefix it shares with any earlier one, so each trie node is scored once. The best
path's token count at a terminal node is what is stored. Documents then add up the stored counts;
nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import at_end, ship

ship(__name__)

COUNTS = "doc_id long, n_words long, n_tokens long"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])
WORD = re.compile("[^\x20\x09-\x0d]+")
#: Stands for the white space before a word.
MARK = "▁"


class UnigramTrie:
    """Token counts of pre-tokens under ``scores`` (piece -> log probability).

    A character that no piece covers becomes its UTF-8 bytes, each at ``byte_score``. Among
    paths of equal score the one with fewer tokens wins, then the one with the longer last piece.
    The trie stays between inserts: a prefix that any earlier pre-token had is not scored again.
    ``keep`` bounds the stored terminals and nodes; beyond it they are let go, and what returns is
    computed again. Nodes deeper than ``DEEP`` are scored but not stored.
    """

    DEEP = 48

    def __init__(self, scores: dict[str, float], byte_score: float, keep: int = 400_000):
        self.scores, self.byte_score, self.keep = scores, byte_score, keep
        self.longest = max(map(len, scores), default=1)
        # The gain of each piece, and none for what only begins a piece.
        self.gains = dict.fromkeys((p[:k] for p in scores for k in range(1, len(p))), -math.inf) | scores
        self.terminals: dict[str, int] = {}
        self.nodes = 0  # scored so far
        self.clear()

    def clear(self) -> None:
        """An empty trie: the root's score and token count, and no edge."""
        self.edges: dict[int, int] = {}  # node and next character -> node
        self.node_scores, self.node_counts = [0.0], [0]

    def insert(self, pretokens: Iterable[str]) -> None:
        """Score all pre-tokens of the set that are not stored yet."""
        new = sorted(pretokens)
        if len(self.terminals) + len(new) > self.keep:
            self.terminals = {}
        path, score, count = [0], [0.0], [0]  # stored nodes, scores and token counts by depth
        before = ""
        for word in new:
            if len(self.node_scores) > self.keep:
                self.clear()
                before = ""
            depth, most = 0, min(len(word), len(before), len(path) - 1)
            while depth < most and word[depth] == before[depth]:
                depth += 1
            del path[depth + 1 :], score[depth + 1 :], count[depth + 1 :]
            while depth < len(word):
                node = self.edges.get(path[depth] << 21 | ord(word[depth]))
                if node is None:
                    break
                path.append(node)
                score.append(self.node_scores[node])
                count.append(self.node_counts[node])
                depth += 1
            self.terminals[word] = self.extend(word, path, score, count)
            before = word

    def extend(self, word: str, path: list[int], score: list[float], count: list[int]) -> int:
        """Score the rest of ``word`` below the path, storing its nodes; the word's token count."""
        get, longest = self.gains.get, self.longest
        gone = 0  # depths of a deep path that no piece can reach back to
        at = len(path) - 1
        begun = [b for b in range(max(0, at - longest), at) if word[b:at] in self.gains]  # where a longer piece may begin
        for end in range(at + 1, len(word) + 1):
            last = word[end - 1]
            n = 1 if last < "\x80" else len(last.encode("utf-8", "replace"))
            best, tokens = score[end - 1 - gone] + n * self.byte_score, count[end - 1 - gone] + n
            begun.append(end - 1)
            going = []
            for begin in begun:
                gain = get(word[begin:end])
                if gain is not None:
                    going.append(begin)
                    s = score[begin - gone] + gain
                    if s >= best:
                        c = count[begin - gone] + 1
                        if s > best or c < tokens:
                            best, tokens = s, c
            begun = going
            score.append(best)
            count.append(tokens)
            self.nodes += 1
            if end <= self.DEEP:
                self.edges[path[-1] << 21 | ord(last)] = len(self.node_scores)
                path.append(len(self.node_scores))
                self.node_scores.append(best)
                self.node_counts.append(tokens)
            elif len(score) > self.DEEP + 2 * longest + 4096:
                kept = len(score) - longest
                gone += kept
                del score[:kept], count[:kept]
        tokens = count[len(word) - gone]
        if gone:  # the path's beginning as it is stored
            score[:] = [self.node_scores[i] for i in path]
            count[:] = [self.node_counts[i] for i in path]
        return tokens

    def counts(self, documents: list[list[str]]) -> list[int]:
        """Tokens of each document, given as its pre-tokens."""
        distinct = set().union(*documents) if documents else set()
        if any(w not in self.terminals for w in distinct):
            missing = distinct - self.terminals.keys()
            if len(self.terminals) + len(missing) > self.keep:
                missing = distinct
            self.insert(missing)
        get = self.terminals.__getitem__
        return [sum(map(get, words)) for words in documents]


def public_scores(name: str = "piece_bpe_32k") -> Callable[[], tuple[dict[str, float], float]]:
    """Unigram log probabilities for a public piece list: its ranks under Zipf's law.

    The file holds merge ranks and no probabilities; nothing is trained here.
    """

    def make():
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{name}.model"))
        ids = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        pieces = sorted(ids, key=lambda i: (-model.get_score(i), i))
        total = math.log(sum(1 / (r + 2) for r in range(len(pieces))))
        scores = {model.id_to_piece(i): -math.log(r + 2) - total for r, i in enumerate(pieces)}
        return scores, -math.log(len(pieces) + 2) - total - 1

    return make


def count_tokens(docs: DataFrame, model: Callable[[], tuple[dict[str, float], float]], *, id_col: str = "doc_id", text_col: str = "text", keep: int = 400_000) -> DataFrame:
    """doc_id, n_words and n_tokens of whole texts; pre-tokens are words with a mark before them.

    Null, empty and blank texts: zero words and tokens. Null ids and repeated rows: a row each.
    Empty table: no rows. Other columns are not read, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = UnigramTrie(*model(), keep=keep)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            begin = 0
            while begin < batch.num_rows:  # about 2 MB of text at a time
                end, held, words = begin, 0, []
                while end < batch.num_rows and held < 1 << 21:
                    text = texts[end].as_py() or ""
                    words.append([MARK + w for w in WORD.findall(text)])
                    held += len(text)
                    end += 1
                yield pa.RecordBatch.from_arrays([ids.slice(begin, end - begin), pa.array(map(len, words), pa.int64()), pa.array(trie.counts(words), pa.int64())], schema=ARROW)
                begin = end

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(at_end(run), COUNTS)
