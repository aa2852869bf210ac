"""Token counts under a unigram vocabulary, scored once per shared prefix of all words."""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import DataFrame

from loomtrace.llm.wordshuffle import apply_to_words

MARK = "▁"


def read_pieces(model_path: str) -> list[tuple[str, float]]:
    """(piece, score) of a vocabulary file's ordinary pieces. A piece's score is taken from
    its rank by Zipf's law, -ln(1 + rank): the file's own scores order merges and are not
    logarithms of probabilities."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ordinary = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [(model.id_to_piece(i), -math.log(1 + rank)) for rank, i in enumerate(ordinary)]


@lru_cache(maxsize=2)
def _lookup(pieces: tuple[tuple[str, float], ...]) -> tuple[dict[str, float], int, float]:
    return dict(pieces), max(len(p) for p, _ in pieces), 10 + max(-s for _, s in pieces)


def count_words(words: list[str], pieces: tuple[tuple[str, float], ...]) -> list[int]:
    """Tokens of each word's best segmentation, words in sorted order.

    The walk is that of a trie: neighbours in sorted order share their prefix's states, so
    a state, the best (score, tokens) of a prefix, is worked out once for all words under it
    and a word's last state is its count. A segmentation's score is the sum of its pieces';
    a character that no piece covers alone falls back to one token a UTF-8 byte, each
    ``10 + the worst score's size`` below zero. Of equal scores fewer tokens win.
    """
    score, longest, byte = _lookup(pieces)
    states: list[tuple[float, int]] = [(0.0, 0)]
    out, last = [], ""
    for word in words:
        same, limit = 0, min(len(word), len(last))
        while same < limit and word[same] == last[same]:
            same += 1
        del states[same + 1 :]
        for end in range(same + 1, len(word) + 1):
            best = None
            for start in range(max(0, end - longest), end):
                s = score.get(word[start:end])
                if s is not None:
                    before = states[start]
                    now = (before[0] + s, -before[1] - 1)
                    if best is None or now > best:
                        best = now
            if word[end - 1 : end] not in score:
                n = len(word[end - 1].encode())
                now = (states[end - 1][0] - byte * n, -states[end - 1][1] - n)
                if best is None or now > best:
                    best = now
            states.append((best[0], -best[1]))
        out.append(states[-1][1])
        last = word
    return out


def token_counts(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, total (tokens of all words).

    A pre-token is a word ``[^\\x20\\x09-\\x0D]+`` with a mark of its beginning before it.
    Null and empty texts have none; rows with equal or null ids stay apart. Every distinct
    pre-token of the table is scored once. Buckets hold words by hash, not by prefix: a
    bucket by prefix would put a third of all words into one task where they share it;
    prefixes are shared within each bucket.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(tuple(read_pieces(model_path)))

    def split(t: str) -> list[bytes]:
        return t.encode().split()

    def work(words: list[bytes]) -> list[list[int]]:
        return [[n] for n in count_words([MARK + w.decode() for w in words], pieces.value)]

    return apply_to_words(docs, split, work, sums=True, text=text)
