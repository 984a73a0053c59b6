"""Token counts of sequences without any space, however long, against the library."""
import random

import public_tokenizers as P
import pyarrow as pa
import sentencepiece

from propensity.llm import piece_count

PIECE = P.path("piece_bpe_32k.model")


def test_long_sequences_equal_the_library():
    rng = random.Random(11)
    model, own = sentencepiece.SentencePieceProcessor(model_file=PIECE), piece_count.PieceCounter(PIECE)
    texts = ["".join(rng.choices(a, k=k)) for a in ("ab", "aab", "ing", "theandofto", "-=_", "0123456789abcdef", "日本語中国人大",
                                                    "éèàüßñ", "etaoinshrdlu", "xX.", "ABCDEFabcdef+/", "нетоиса")
             for k in (3, 40, 600, 5_000) for _ in range(3)]
    texts += ["a" * k for k in (*range(1, 70), 9_999)] + [" " * k + "b" * k for k in range(1, 60)] + ["ab" * 3_000, "nging" * 900]
    n_bytes, n_tokens = own.texts(pa.array(texts))
    assert n_bytes.tolist() == [len(t.encode()) for t in texts]
    want = [len(x) for x in model.encode(texts, num_threads=1)]
    assert [(w, n, t[:60]) for w, n, t in zip(want, n_tokens.tolist(), texts) if w != n] == []


class Toy(piece_count.PieceCounter):
    """Rules given by hand; rank is the order of the list."""

    def __init__(self, pieces):
        rank = {p: k for k, p in enumerate(pieces)}
        symbols = {s: k for k, s in enumerate([*pieces, *sorted({c for p in pieces for c in p} - rank.keys())])}
        rules = [(symbols[p[:k]], symbols[p[k:]], rank[p], symbols[p]) for p in pieces for k in range(1, len(p))
                 if p[:k] in symbols and p[k:] in symbols]
        near = sorted({(symbols[a], symbols[b]) for p in pieces for a, b in zip(p, p[1:])})
        np = piece_count.np
        self.table = piece_count.PairTable(*np.array(rules, dtype=np.int64).reshape(-1, 4).T)
        none = np.zeros(len(near), dtype=np.int64)
        self.near = piece_count.PairTable(*np.array(near, dtype=np.int64).reshape(-1, 2).T, none, none)
        self.first = np.full(0x110000, -1, dtype=np.int64)
        for s, k in symbols.items():
            if len(s) == 1:
                self.first[ord(s)] = k
        self.known = np.zeros(len(symbols) + 1, dtype=bool)
        self.known[[symbols[p] for p in pieces]] = True


def one_by_one(text, pieces):
    rank, sym = {p: k for k, p in enumerate(pieces)}, list(text)
    while True:
        found = [(rank[a + b], i) for i, (a, b) in enumerate(zip(sym, sym[1:])) if a + b in rank]
        if not found:
            return sum(1 if s in rank else len(s.encode()) for s in sym)
        i = min(found)[1]
        sym[i:i + 2] = [sym[i] + sym[i + 1]]


def test_joins_that_bring_in_a_lower_rank_go_first():
    rng, np = random.Random(5), piece_count.np
    for _ in range(300):
        pieces = list({"".join(rng.choices("abc", k=rng.randrange(2, 6))) for _ in range(rng.randrange(2, 12))})
        rng.shuffle(pieces)
        toy = Toy(pieces)
        texts = ["".join(rng.choices("abcd", k=rng.randrange(1, 40))) for _ in range(30)]
        got = toy.count(np.array([ord(c) for t in texts for c in t]), np.array([len(t) for t in texts]))
        assert got.tolist() == [one_by_one(t, pieces) for t in texts]
