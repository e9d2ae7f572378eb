from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from tallyroll.llm import byte_bpe, byte_pairs, packing, queries, token_counts
from tallyroll.llm.words import span_hashes

SF = "/root/testdata/sf0.001"
RANKS = byte_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
JSON = byte_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
MODEL = byte_bpe.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
ODD = [
    "", " ", "  ", "\n", "a'sb 's don't we'll I'M it''s '''s 'tx we're'd", "a\n\nb  c \n d\t e\r\n", "x" * 5000, "ab" * 3000,
    " " * 500 + "x", "'", "''", "'re", "'r", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>",
    "▁a ▁▁b ", "<s>x</s><unk>", "ﬁ ① Å é 　 \u0085   \U0001f600\U00020000", "a \n b\n\n  c\n", "\x00\x1c\x1f",
]


def samples():
    rng = random.Random(11)
    points = [*range(0x250), *range(0x300, 0x700), 0x1680, 0x2000, 0x2028, 0x2581, 0x3000, 0x200B, 0xFEFF, 0x1F600, 0x4E00, 0x2167]
    texts = ["".join(chr(rng.choice(points)) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["".join(rng.choice("abs'tmdrevl \n1.") for _ in range(rng.randrange(50))) for _ in range(1500)]
    return ODD + texts + ["".join(rng.choice("ab") for _ in range(rng.randrange(400))) for _ in range(200)]


def lists(encoded):
    ids, bounds = encoded
    return [ids[start:end].tolist() for start, end in zip(bounds[:-1], bounds[1:])]


def tiktoken_encoding():
    ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ranks_as_the_library():
    texts = samples()
    encoding = tiktoken_encoding()
    assert lists(byte_pairs.rank_encoder(RANKS).encode(texts)) == [encoding.encode_ordinary(text) for text in texts]


def test_json_as_the_library(monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 50)  # forgets between batches
    texts = samples()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = byte_pairs.TextEncoder(byte_pairs.merges_of_json(JSON))
    found = [ids for start in range(0, len(texts), 300) for ids in lists(encoder.encode(texts[start : start + 300]))]
    assert found == [each.ids for each in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_piece_counts_as_the_library():
    texts = samples()
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    assert token_counts.PieceCounter(MODEL).count(texts) == [len(library.encode(text)) for text in texts]


def odd_documents(spark):
    rows = [(number, text, "en", None if number % 3 else f"s{number % 5}", 1) for number, text in enumerate([*ODD, None, None])]
    rows += [(None, "no id", None, "s1", None), (4, ODD[4], "en", None, 1), (4, ODD[4], "en", None, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema).selectExpr("*", "1 AS ids", "'x' AS block", "2 AS `a.b`").repartition(3)


def whole_documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("documents", [odd_documents, whole_documents])
def test_round_trip(spark, documents):
    documents = documents(spark)
    encoding = tiktoken_encoding()
    wanted = []
    for row in documents.select("doc_id", "text").collect():
        ids = encoding.encode_ordinary(row.text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        wanted.append((str(row.doc_id), len(ids), digest, hashlib.sha256((row.text or "").encode()).hexdigest()))
    found = byte_bpe.digests(byte_bpe.decoded(byte_bpe.encoded(documents, RANKS), RANKS))
    assert sorted((str(row[0]), *row[1:]) for row in found.collect()) == sorted(wanted)
    assert byte_bpe.encoded(documents.limit(0), RANKS).count() == 0


@pytest.mark.parametrize("documents", [odd_documents, whole_documents])
def test_counts(spark, documents):
    documents = documents(spark)
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    wanted = []
    for row in documents.select("doc_id", "text").collect():
        count = len(library.encode(row.text or ""))
        wanted.append((str(row.doc_id), len((row.text or "").encode()), count, count > 4096))
    found = token_counts.token_counts(documents, MODEL)
    assert sorted((str(row[0]), *row[1:]) for row in found.collect()) == sorted(wanted)
    assert token_counts.token_counts(documents.limit(0), MODEL).count() == 0


@pytest.mark.parametrize(("documents", "length"), [(odd_documents, 64), (whole_documents, 1024), (whole_documents, 8)])
def test_packing(spark, documents, length):
    documents = documents(spark)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = defaultdict(int)
    sources = defaultdict(int)
    of_doc = {}
    for row in documents.collect():
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 0]
        wanted[str(row.doc_id), tuple(ids)] += 1
        sources[row.source] += len(ids)
        of_doc[row.doc_id] = row.source
    pieces = packing.packed(documents, JSON, length).collect()
    total = sum(sources.values())
    parts, windows = defaultdict(list), defaultdict(list)
    for piece in pieces:
        ids = np.frombuffer(piece.ids, "<u4").tolist()
        assert len(ids) == piece.length > 0
        parts[str(piece.doc_id)].append((piece.start, ids, piece.doc_tokens))
        windows[piece.sequence_id].append((piece.offset, piece.length, of_doc[piece.doc_id]))
    for doc_id, found in parts.items():
        copies = {ids: times for (other, ids), times in wanted.items() if other == doc_id}
        assert len(copies) == 1
        ((ids, times),) = copies.items()
        cover = np.zeros(len(ids), int)
        for start, part, doc_tokens in found:
            assert doc_tokens == len(ids) and list(ids[start : start + len(part)]) == part
            cover[start : start + len(part)] += 1
        assert (cover == times).all()
    assert sorted(windows) == list(range(-(-total // length)))
    for number, found in windows.items():
        at = 0
        for offset, size, _ in sorted(found):
            assert offset == at
            at += size
        assert at == (length if number < len(windows) - 1 else total - length * (len(windows) - 1))
    # Up to any window each source with a queue of its own has been served its share, to within two tokens.
    queues, _ = packing._queues(packing.tokenized(documents, JSON), length)
    assert queues or length == 8  # there, no source has a token in each sequence
    for source, size in sources.items():
        if (f"={source}" if source else "") in queues:
            served = 0
            for number in range(len(windows) - 1):
                served += sum(size for _, size, other in windows[number] if other == source)
                assert abs(served - size * length * (number + 1) / total) <= 2
    assert packing.packed(documents.limit(0), JSON, length).count() == 0


def test_checksum(spark):
    (row,) = packing.checksums(packing.packed(spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string"), JSON)).collect()
    assert row.ids_crc32 == zlib.crc32(np.array([64, 0], "<u4").tobytes()) and row.length == 2


def test_queries(spark):
    found = queries.queries()
    for name in ("op3_byte_bpe", "op6_packing", "op9_token_counts"):
        assert found[name](spark, SF).count() >= 200


def thue_morse(letters: str, size: int) -> str:
    """A word whose hash, as a sum of letters times powers, equals that of the word with letters exchanged."""
    return "".join(letters[place.bit_count() % 2] for place in range(size))


@pytest.mark.parametrize("size", [8, 32, 64, 1024, 4096])
def test_words_that_sums_of_powers_confuse(size):
    pair = [thue_morse("ab", size), thue_morse("ba", size)]
    texts = [*pair, " ".join(pair), pair[1] + " x " + pair[0]]
    encoding = tiktoken_encoding()
    assert lists(byte_pairs.rank_encoder(RANKS).encode(texts)) == [encoding.encode_ordinary(text) for text in texts]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert lists(byte_pairs.json_encoder(JSON).encode(texts)) == [
        each.ids for each in tokenizer.encode_batch(texts, add_special_tokens=False)
    ]


@pytest.mark.parametrize("kept", [1, 3, 64])
def test_words_that_share_a_hash_are_told_apart(monkeypatch, kept):
    """Whatever the hashes are, the ids are right: here one hash stands for many words."""
    monkeypatch.setattr(byte_pairs, "pretoken_hashes", lambda points, starts: (points[starts] % kept).astype(np.uint64))
    texts = samples()[:800]
    encoder = byte_pairs.TextEncoder(byte_pairs.merges_of_ranks(RANKS))
    encoding = tiktoken_encoding()
    found = [ids for start in range(0, len(texts), 100) for ids in lists(encoder.encode(texts[start : start + 100]))]
    assert found == [encoding.encode_ordinary(text) for text in texts]


def test_hashes_of_spans():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 4, 40_000, dtype=np.uint8)
    ends = np.sort(rng.integers(0, len(data) + 1, (20_000, 2)), axis=1)
    ends[:, 1] = np.minimum(ends[:, 1], ends[:, 0] + rng.choice([0, 1, 3, 8, 9, 16, 40, 511, 512, 513, 900], len(ends)))
    spans = [data[first:last].tobytes() for first, last in ends.tolist()]
    hashes = span_hashes(data, ends[:, 0], ends[:, 1]).tolist()
    assert len(dict(zip(spans, hashes, strict=True))) == len(set(spans)) == len(set(hashes))
    assert all(dict(zip(spans, hashes, strict=True))[span] == each for span, each in zip(spans, hashes, strict=True))


def test_windows_of_several_sequences_hold_long_pieces_in_proportion(spark):
    documents = whole_documents(spark)
    window = packing.WINDOW
    pieces = packing.packed(documents, JSON, window=window).join(documents.select("doc_id", "source"), "doc_id").toPandas()
    shares = pieces.groupby("source").length.sum() / pieces.length.sum()
    whole = pieces.sequence_id.max() // window * window
    for first in range(0, whole, window):
        part = pieces[pieces.sequence_id.between(first, first + window - 1)]
        served = part.groupby("source").length.sum() / (1024 * window)
        assert (served.reindex(shares.index).fillna(0) - shares).abs().max() < 0.001
    assert pieces.length.median() >= 200
    ends = pieces.groupby("sequence_id").length.sum()
    assert (ends.iloc[:-1] == 1024).all()
    cover = pieces.sort_values(["doc_id", "start"]).groupby("doc_id")
    assert (cover.length.sum() == cover.doc_tokens.first()).all()
    assert all(group.start.tolist() == [0, *group.length.cumsum().tolist()[:-1]] for _, group in cover)


def test_targets_hold_until_a_queue_runs_empty(spark):
    rows = [(number, "word " * 40, source) for number, source in enumerate("a" * 60 + "b" * 60 + "c" * 60)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.packed(documents, JSON, length=64, targets={"a": 0.5, "b": 0.25}).join(documents.drop("text"), "doc_id").toPandas()
    served = pieces.groupby(["sequence_id", "source"]).length.sum().unstack(fill_value=0)
    total = served.a.sum()
    both = served[served.a.cumsum() < total - 64]
    assert (both.a - 2 * both.b).abs().max() <= 3 and both.c.sum() == 0
    assert served.sum().tolist() == [total] * 3
    # The source without a target comes last.
    assert served[served.c > 0].index.min() >= served[served.b > 0].index.max()
    assert pieces.groupby("sequence_id").length.sum().iloc[:-1].eq(64).all()


@pytest.mark.parametrize("seed", range(6))
def test_pieces_cover_the_output_once(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 500, rng.integers(1, 6))
    targets = None if seed % 2 else rng.random(len(sizes)) * rng.integers(0, 2, len(sizes))
    plan, total = packing.phases(sizes, targets), int(sizes.sum())
    seen = np.zeros(total, int)
    for queue, size in enumerate(sizes.tolist()):
        place = 0
        while place < size:
            step = min(size - place, int(rng.integers(1, 90)))
            starts, counts, sequences, offsets = packing.pieces_of(plan, 16, 3, queue, place, step)
            assert starts.tolist() == [0, *np.cumsum(counts)[:-1].tolist()] and counts.sum() == step and counts.min() > 0
            for sequence, offset, count in zip(sequences, offsets, counts, strict=True):
                assert offset + count <= 16
                seen[sequence * 16 + offset : sequence * 16 + offset + count] += 1
            place += step
    assert (seen == 1).all()
