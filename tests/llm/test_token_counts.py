import random
import re

from dayfacts.llm import token_counts as T


def viterbi(word, scores, byte_score):
    """Most probable segmentation of one word on its own: its number of tokens."""
    best = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode("utf-8", "replace"))
        s, c = best[end - 1]
        top = (s + n * byte_score, c + n)
        for begin in range(end):
            gain = scores.get(word[begin:end])
            if gain is not None:
                s, c = best[begin]
                if s + gain > top[0] or (s + gain == top[0] and c + 1 < top[1]):
                    top = (s + gain, c + 1)
        best[end] = top
    return best[-1][1]


def test_trie_agrees_with_word_by_word():
    rng = random.Random(1)
    scores = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): -rng.random() * 5 for _ in range(25)}
    words = {"".join(rng.choice("abcdé") for _ in range(rng.randint(1, 12))) for _ in range(500)}
    trie = T.UnigramTrie(scores, -7.0)
    trie.insert(words)
    assert trie.terminals == {w: viterbi(w, scores, -7.0) for w in words}
    prefixes = {w[:k] for w in words for k in range(1, len(w) + 1)}
    assert trie.nodes == len(prefixes)  # each shared prefix is scored once


def test_the_trie_stays_between_batches():
    rng = random.Random(2)
    scores = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): -rng.random() * 5 for _ in range(25)}
    trie, seen = T.UnigramTrie(scores, -7.0), set()
    for _ in range(4):
        words = {"".join(rng.choice("abcdé") for _ in range(rng.randint(1, 12))) for _ in range(200)}
        seen |= words
        assert trie.counts([list(words)]) == [sum(viterbi(w, scores, -7.0) for w in words)]
        assert trie.nodes == len({w[:k] for w in seen for k in range(1, len(w) + 1)})


def test_very_long_words():
    rng = random.Random(3)
    scores = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 5))): -rng.random() * 5 for _ in range(20)}
    trie = T.UnigramTrie(scores, -7.0)
    for length in (47, 48, 49, 60, 5000, 9000, 13_000):
        word = "".join(rng.choice("abc") for _ in range(length))
        words = [word, word + "b", word[:-1], "a" + word]
        assert trie.counts([[w] for w in words]) == [windowed(w, scores, -7.0, 5) for w in words]
    assert len(trie.node_scores) <= 1 + 48 * 4 * 7


def windowed(word, scores, byte_score, longest):
    """As ``viterbi``, with pieces of at most ``longest`` characters."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode("utf-8", "replace"))
        s, c = best[end - 1]
        paths = [(s + n * byte_score, -c - n, 0)]
        for begin in range(max(0, end - longest), end):
            if word[begin:end] in scores:
                s, c = best[begin]
                paths.append((s + scores[word[begin:end]], -c - 1, 0))
        top = max(paths)
        best.append((top[0], -top[1]))
    return best[-1][1]


def test_a_small_store_changes_nothing():
    scores, byte_score = T.public_scores()()
    docs = [["▁the", "▁thing"], ["▁other", "▁the"], [], ["▁日本"]]
    want = [sum(viterbi(w, scores, byte_score) for w in d) for d in docs]
    for keep in (1, 2, 1000):
        trie = T.UnigramTrie(scores, byte_score, keep=keep)
        assert trie.counts(docs) == want and trie.counts(docs[::-1]) == want[::-1]


def brute(docs):
    scores, byte_score = T.public_scores()()
    memo = {}

    def count(w):
        if w not in memo:
            memo[w] = viterbi("▁" + w, scores, byte_score)
        return memo[w]

    return sorted(((r.doc_id, len(w), sum(map(count, w))) for r in docs.collect() for w in [re.findall("[^\x20\x09-\x0d]+", r.text or "")]), key=str)


def test_whole_texts(small, awkward):
    ordinary = awkward.filter("doc_id is null or doc_id != 6")  # its one word of 50,000 letters is slow by brute force
    for docs in (small["documents"].limit(60), ordinary):
        assert sorted(map(tuple, T.count_tokens(docs, T.public_scores()).collect()), key=str) == brute(docs)
    (long,) = T.count_tokens(awkward.filter("doc_id = 6"), T.public_scores()).collect()
    assert long.n_words == 1 and long.n_tokens > 1000
    assert T.count_tokens(awkward.limit(0), T.public_scores()).count() == 0
