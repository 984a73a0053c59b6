"""BPE encoding and decoding, token counts, token stores and packing against the libraries themselves."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from propensity.llm import bestfit_pack as B
from propensity.llm import piece_count, repair_tokens, word_bpe
from propensity.llm.chunk_encoder import ChunkEncoder

from .conftest import ODD, pairs

WORD, BYTE, PIECE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
rng = random.Random(3)
ALPHABET = list("abcdefgetnioTS  \n\t.,'!-0123éÉßΣσçñ日本語 İǅﬁⅣ \u0085 \x1c▁👍🏽é<|>") + [
    "<|endoftext|>", "<|startoftext|>", "the ", " and", "'ll", "  ", "<s>", "ing", "tion"]
RANDOM = ["".join(rng.choices(ALPHABET, k=rng.randrange(60))) for _ in range(1500)]
TEXTS = RANDOM + [t or "" for _, t in ODD] + ["a" * 1500 + "ab" * 900, " " * 700 + "x"]


def library(path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def test_word_bpe_equals_the_library():
    t, own = library(WORD), word_bpe.WordBpe(WORD)
    for text in TEXTS:
        ids = t.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, repr(text)
        assert own.decode(ids) == t.decode(ids, skip_special_tokens=False)


def test_pair_index_of_many_words_at_once():
    t, own = library(WORD), word_bpe.WordBpe(WORD)
    words = sorted({w for x in TEXTS for w in own.words(x)} - set(own.special))
    ids, size = own.merge(words)
    assert np.split(ids, np.cumsum(size)[:-1])[-1].tolist() == t.encode(words[-1], add_special_tokens=False).ids
    assert ids.tolist() == [i for w in words for i in t.encode(w, add_special_tokens=False).ids]


def test_chunks_equal_the_library():
    import pyarrow as pa
    t, own = library(BYTE), ChunkEncoder(BYTE, max_chunks=700)
    for k in range(0, len(TEXTS), 50):
        flat, at = own.encode(pa.array(TEXTS[k:k + 50]))
        for j, text in enumerate(TEXTS[k:k + 50]):
            assert flat[at[j]:at[j + 1]].tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_piece_counts_equal_the_library():
    import pyarrow as pa
    import sentencepiece
    model, own = sentencepiece.SentencePieceProcessor(model_file=PIECE), piece_count.PieceCounter(PIECE)
    n_bytes, n_tokens = own.texts(pa.array(TEXTS))
    assert n_bytes.tolist() == [len(t.encode()) for t in TEXTS]
    want = [len(x) for x in model.encode(TEXTS, num_threads=1)]
    assert [(w, n, t) for w, n, t in zip(want, n_tokens.tolist(), TEXTS) if w != n] == []


def sort(rows):
    return sorted(rows, key=str)


def test_encode_decode_rows(small, odd, clash, none):
    t = library(WORD)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for df in (small, odd, clash, none):
        want = []
        for i, text in pairs(df):
            ids = t.encode(text, add_special_tokens=False).ids
            want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
        assert sort(tuple(r) for r in word_bpe.encode_decode(df, WORD).collect()) == sort(want)


def test_token_count_rows(small, odd, clash, none):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for df in (small, odd, clash, none):
        want = [(i, len(x.encode()), n := len(model.encode(x)), n > 4096) for i, x in pairs(df)]
        assert sort(tuple(r) for r in piece_count.token_counts(df, PIECE).collect()) == sort(want)


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("shard", [8 << 20, 20_000])
def test_store_round_trip(small, odd, clash, none, shard, monkeypatch):
    monkeypatch.setattr(repair_tokens, "SHARD_BYTES", shard)
    monkeypatch.setattr(repair_tokens, "PART_BYTES", 4 * shard)
    t = library(BYTE)
    for df in (small, odd, clash, none):
        rows = repair_tokens.read_store(repair_tokens.write_store(df, BYTE)).collect()
        ids = [(i, [*t.encode(x, add_special_tokens=False).ids, 0]) for i, x in pairs(df)]
        want = Counter((i, len(x), crc(x)) for i, x in ids)
        assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
        rows.sort(key=lambda r: r["start"])
        assert [r["start"] for r in rows] == [sum(r["n_tokens"] for r in rows[:k]) for k in range(len(rows))]
        known = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
        assert known == sorted(known)


def test_random_access_and_size(small):
    t = library(BYTE)
    texts = dict(pairs(small))
    for row in repair_tokens.write_store(small, BYTE).collect():
        shard = repair_tokens.Shard(row.asDict())
        for k in range(0, len(shard.doc_ids), 7):
            ids = [*t.encode(texts[shard.doc_ids[k]], add_special_tokens=False).ids, 0]
            for lo, hi in ((0, len(ids)), (len(ids) // 3, len(ids) // 2 + 1), (len(ids) - 1, len(ids))):
                assert shard.read(k, lo, hi).tolist() == ids[lo:hi]
        assert len(shard.symbols) < 0.75 * row["n_tokens"]


def plain_best_fit(sizes, limit):
    """Sequences that best fit, longest first, needs."""
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = min((g for g in gaps if g >= s), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((limit if fit is None else fit) - s)
    return len(gaps)


def test_rounds_equal_one_by_one_best_fit():
    r = random.Random(9)
    for limit in (10, 64, 1024):
        for _ in range(40):
            sizes = [r.choice((limit, r.randint(1, limit), r.randint(1, max(1, limit // 5)))) for _ in range(r.randint(0, 300))]
            p = B.plan(Counter(sizes), limit)
            assert p.sequences == plain_best_fit(sizes, limit)
            length = np.array(sorted(sizes), dtype=np.int64)
            rank = np.arange(len(length)) - np.searchsorted(length, length)
            room = defaultdict(list)
            if len(length):
                for s, o, n in zip(*p.place(length, rank), length):
                    room[int(s)].append((int(o), int(n)))
            for places in room.values():
                at = 0
                for o, n in sorted(places):
                    assert o == at
                    at += n
                assert at <= limit


@pytest.mark.parametrize("bucket", [50_000, 20])
def test_packed_rows(small, odd, clash, none, bucket, monkeypatch):
    monkeypatch.setattr(B, "BUCKET_ROWS", bucket)
    t = library(BYTE)
    for df in (small, odd, clash, none):
        want = []
        for i, x in pairs(df):
            ids = [*t.encode(x, add_special_tokens=False).ids, 2]
            cut = [0, *range(len(ids) - (len(ids) - 1) // 1024 * 1024, len(ids) + 1, 1024)]
            want += [(i, k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cut, cut[1:]))]
        rows = B.pack(df, BYTE).collect()
        assert Counter(tuple(r)[:5] for r in rows) == Counter(want)
        room = defaultdict(list)
        for r in rows:
            room[r["sequence_id"]].append((r["offset"], r["length"]))
        for places in room.values():
            at = 0
            for o, n in sorted(places):
                assert o == at
                at += n
            assert at <= 1024
        assert len(room) == plain_best_fit([w[3] for w in want], 1024)


def test_pieces_with_ids(odd):
    rows = B.pack(odd, BYTE, with_ids=True).collect()
    assert all(crc(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in rows)
