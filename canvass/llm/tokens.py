"""Operator 9: token counts by dynamic programming over a trie of pre-tokens.

A unigram vocabulary (pieces with log probabilities) gives every pre-token its best segmentation.  The distinct
pre-tokens of a batch are a trie, kept as sorted levels: the nodes of depth d are the distinct prefixes of d
characters.  The forward score of a node is found once, from its ancestors, for all words that share it; the
node where a word ends stores its token count.  All nodes of a depth are computed at once.  Words of over LONG
characters share no prefix worth a level for each character; they run through the same scores one by one.

The vocabulary file at hand holds pieces in order of merging, not probabilities.  A piece's probability is
taken from its rank by Zipf's law, so the counts are those of a unigram model over the file's pieces; the
file's own tokenizer merges greedily and may count otherwise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._words import NOT_SPACE, Words, in_batches, mix, slices

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_SCORE = -1e5
REMEMBERED = 2_000_000
LONG = 64
ZIPF_SHIFT = 2.7
_STEP = np.uint64(0xD6E8FEB86659FD93)


def vocabulary(path: str = VOCABULARY) -> dict[str, float]:
    """Pieces of a sentencepiece model file with log probabilities by rank, p ~ 1 / (rank + ZIPF_SHIFT).

    Pieces rank by the file's scores.  Control, unknown and byte pieces are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ids.sort(key=lambda i: (-model.get_score(i), i))
    weight = 1 / (np.arange(len(ids)) + ZIPF_SHIFT)
    return dict(zip(map(model.id_to_piece, ids), np.log(weight / weight.sum()).tolist(), strict=True))


class TrieCounter:
    """Token counts of pre-tokens under a unigram vocabulary; counts of words seen before are remembered."""

    def __init__(self, pieces: dict[str, float], mark: str = "▁") -> None:
        self.mark = mark
        hashes = {}
        for piece, score in pieces.items():
            key = self._hash(piece)
            hashes[key] = max(score, hashes.get(key, -np.inf))
        keys = sorted(hashes)
        self.keys = np.array(keys, np.uint64)
        self.scores = np.array([hashes[k] for k in keys], float)
        self.longest = max(map(len, pieces), default=1)
        self.known_hash, self.known_count = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for ch in text:
            h = (h * int(_STEP) + ord(ch) + 1) % (1 << 64)
        return int(mix(np.array([h], np.uint64))[0])

    def count_words(self, words: list[str]) -> np.ndarray:
        """Tokens of each of the distinct ``words``, each with the mark before it.

        Characters that no piece covers are tokens of their own.
        """
        if not words:
            return np.zeros(0, np.int32)
        if any(len(w) > LONG for w in words):
            short = [w for w in words if len(w) <= LONG]
            counts = iter(self.count_words(short).tolist())
            return np.array([self.count_long(w) if len(w) > LONG else next(counts) for w in words], np.int32)
        order = sorted(range(len(words)), key=words.__getitem__)
        chars = [np.frombuffer((self.mark + words[i]).encode("utf-32-le", "surrogatepass"), np.uint32) for i in order]
        lengths = np.array([len(c) for c in chars])
        starts = np.cumsum(lengths) - lengths
        flat = np.concatenate(chars).astype(np.uint64) + np.uint64(1)
        powers = np.ones(self.longest + 1, np.uint64)
        powers[1:] = np.cumprod(np.full(self.longest, _STEP, np.uint64), dtype=np.uint64)
        # State of the level above: by word, its node; by node and depth, forward score and count.
        deepest = int(lengths.max())
        node = np.zeros(len(chars), np.int64)  # all words begin at the root
        score, count = [np.zeros(1)], [np.zeros(1, np.int32)]
        parents: list[np.ndarray] = [np.zeros(1, np.int64)]
        prefix_hash = [np.zeros(1, np.uint64)]  # of the whole prefix, for the hash of its last characters
        out = np.zeros(len(chars), np.int32)
        for depth in range(1, deepest + 1):
            live = np.flatnonzero(lengths >= depth)
            ch = flat[starts[live] + depth - 1]
            above = node[live]
            # Words are sorted, so those that share a prefix stand together.
            new = np.ones(len(live), bool)
            new[1:] = (above[1:] != above[:-1]) | (ch[1:] != ch[:-1])
            own = np.cumsum(new) - 1
            heads = np.flatnonzero(new)
            parent, letter = above[heads], ch[heads]
            whole = prefix_hash[-1][parent] * _STEP + letter
            parents.append(parent)
            prefix_hash.append(whole)
            best, number = score[-1][parent] + UNKNOWN_SCORE, count[-1][parent] + 1
            ancestor = parent
            for size in range(1, min(depth, self.longest) + 1):
                key = mix(whole - prefix_hash[depth - size][ancestor] * powers[size])
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                total = np.where(self.keys[place] == key, score[depth - size][ancestor] + self.scores[place], -np.inf)
                fewer = count[depth - size][ancestor] + 1
                better = (total > best) | (total == best) & (fewer < number)
                best, number = np.where(better, total, best), np.where(better, fewer, number)
                if size < depth:
                    ancestor = parents[depth - size][ancestor]
            score.append(best)
            count.append(number.astype(np.int32))
            node[live] = own
            ends = live[lengths[live] == depth]
            out[ends] = count[-1][node[ends]]
        result = np.zeros(len(words), np.int32)
        result[order] = out
        return result

    def count_long(self, word: str) -> int:
        """Tokens of one word of any length: pieces are looked up at all places at once, size by size; then the
        scores run forward over the pieces found, in order of their ends."""
        ch = np.frombuffer((self.mark + word).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        n = len(ch)
        up, down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)]), dtype=np.uint64) for x in (_STEP, np.uint64(pow(int(_STEP), -1, 1 << 64))))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ch * down[:n], dtype=np.uint64)])
        ends, starts, scores = [], [], []
        alone = np.ones(n, bool)
        for size in range(1, min(n, self.longest) + 1):
            key = mix((total[size:] - total[:-size]) * up[size - 1 : n])
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            at = np.flatnonzero(self.keys[place] == key)
            starts.append(at)
            ends.append(at + size)
            scores.append(self.scores[place[at]])
            if size == 1:
                alone[at] = False
        at = np.flatnonzero(alone)
        start, end, gain = np.concatenate([*starts, at]), np.concatenate([*ends, at + 1]), np.concatenate([*scores, np.full(len(at), UNKNOWN_SCORE)])
        order = np.argsort(end, kind="stable")
        best, number = [-np.inf] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for part in range(0, len(order), 100_000):
            some = order[part : part + 100_000]
            for s, e, g in zip(start[some].tolist(), end[some].tolist(), gain[some].tolist(), strict=True):
                g += best[s]
                if g > best[e] or g == best[e] and number[s] + 1 < number[e]:
                    best[e], number[e] = g, number[s] + 1
        return number[n]

    def count_batch(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, tokens) of each text."""
        words = Words(data, offsets, NOT_SPACE, lower=False)
        distinct, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        counts = np.zeros(len(distinct), np.int32)
        place = np.minimum(np.searchsorted(self.known_hash, distinct), max(0, len(self.known_hash) - 1))
        seen = self.known_hash[place] == distinct if len(self.known_hash) else np.zeros(len(distinct), bool)
        counts[seen] = self.known_count[place[seen]]
        todo = np.flatnonzero(~seen)
        raw = data.tobytes()
        counts[todo] = self.count_words([raw[words.start[i] : words.end[i]].decode("utf-8", "replace") for i in first[todo].tolist()])
        if len(self.known_hash) + len(todo) > REMEMBERED:  # memory stays bounded
            self.known_hash, self.known_count = distinct, counts
        elif len(todo):
            every, tally = np.concatenate([self.known_hash, distinct[todo]]), np.concatenate([self.known_count, counts[todo]])
            order = np.argsort(every)
            self.known_hash, self.known_count = every[order], tally[order]
        sums = np.concatenate([[0], np.cumsum(counts[inverse], dtype=np.int64)])
        return words.counts(), sums[words.first[1:]] - sums[words.first[:-1]]


def token_counts(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens of every whole text, a row per row; null and empty texts have none.

    Rows are counted where they are: nothing is shuffled, and a task keeps one batch's trie at a time.  The
    vocabulary, read once on the driver, is broadcast; its size is that of the file, not of the data.
    """
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary(path))
    kind = documents.schema["doc_id"].dataType.simpleString()

    def read(batches):
        counter = TrieCounter(sent.value)
        for batch in batches:
            n, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, data, offsets in slices(batch.column("text"), 8_000_000):
                a, b = counter.count_batch(data, offsets)
                n.append(a)
                tokens.append(b)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(n), pa.int64()), pa.array(np.concatenate(tokens), pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return in_batches(documents.select("doc_id", "text")).mapInArrow(read, f"doc_id {kind}, n_words long, n_tokens long")


def report(documents: DataFrame) -> DataFrame:
    return token_counts(documents).select("doc_id", F.col("n_words"), F.col("n_tokens"))
