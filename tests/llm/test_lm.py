"""Lattice likelihood against an enumeration of all segmentations, and the SentencePiece codec against its library."""

import itertools
import json
import math
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_cases import ODD, SF_SMALL
from pyspark.sql import functions as F
from tokenizers import decoders

from roadlake.llm import sp_codec, subword_lm
from roadlake.llm.shared import id_crc
from roadlake.llm.sp_model import parse_model

PATH = public_tokenizers.path("piece_bpe_32k.model")


def segmentations(word):
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        out, part = [], word[0]
        for c, cut in zip(word[1:], cuts):
            if cut:
                out.append(part)
                part = c
            else:
                part += c
        yield [*out, part]


def brute(word, weights):
    return sum(math.prod(weights[p] for p in s) for s in segmentations(word) if all(p in weights for p in s))


PIECES = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "bab", "c"]
WEIGHTS = np.array([0.1, 0.2, 0.1, 0.1, 0.15, 0.05, 0.1, 0.05, 0.05, 0.1])


def test_forward_sums_over_all_segmentations():
    lat = subword_lm.lattice(PIECES, [-1] * 256)
    w = dict(zip(PIECES, WEIGHTS))
    words = [b"a", b"ab", b"abab", b"babc", b"cabbabab", b"b"]
    got = subword_lm.word_logs(lat, words, subword_lm.log_weights(WEIGHTS))
    for x, g in zip(words, got):
        assert g == pytest.approx(math.log10(brute("▁" + x.decode(), w)), abs=1e-10)


def test_expected_counts():
    lat = subword_lm.lattice(PIECES, [-1] * 256)
    w = dict(zip(PIECES, WEIGHTS))
    word, uses, total = "▁ababab", Counter(), 0.0
    for s in segmentations(word):
        if all(p in w for p in s):
            p = math.prod(w[x] for x in s)
            total += p
            for x in s:
                uses[x] += p
    got = subword_lm.expected(lat, *subword_lm.arcs_of(lat, [word]), subword_lm.log_weights(WEIGHTS), np.array([3.0]))
    for p, g in zip(PIECES, got):
        assert g == pytest.approx(3 * uses[p] / total, abs=1e-9)


def test_bytes_spell_characters_without_a_piece():
    lat, weights = subword_lm.vocabulary(PATH)
    logs = subword_lm.log_weights(weights)
    got = subword_lm.word_logs(lat, ["\U0001f9ff".encode()], logs)[0]
    spelt = sum(logs[lat.byte_index[b]] for b in "\U0001f9ff".encode()) + logs[lat.pieces.index("▁")]
    assert got == pytest.approx(spelt / math.log(10))


def test_probabilities_of_all_words_sum_to_one():
    """Whole-word arcs and segmentations into pieces share one unit of probability with the end."""
    pieces, weights = ["▁", "▁a", "a", "b", "ab"], np.array([0.15, 0.1, 0.1, 0.1, 0.05, 0.5])
    lat = subword_lm.lattice(pieces, [-1] * 256)
    counts = {b"a": 3, b"ab": 1, b"bba": 2}
    words = [bytes(w) for n in range(0, 9) for w in itertools.product(b"ab", repeat=n)]
    n_train = 4
    parted = subword_lm.shares(lat, weights, sum(counts.values()) + n_train, len(counts) + 1, n_train)
    logs = subword_lm.word_logs(lat, words, subword_lm.log_weights(weights))
    w = dict(zip(pieces, weights))
    for x, g in zip(words[:60], logs):
        assert g == pytest.approx(math.log10(brute("▁" + x.decode(), w)), abs=1e-9)
    total = (10 ** parted.words(np.array([counts.get(x, 0) for x in words]), logs)).sum() + 10**parted.end
    assert 0.9999 < total <= 1 + 1e-9  # words of more than eight letters are the rest
    alone = subword_lm.shares(lat, weights, 0, 0, 0)
    total = (10 ** alone.words(np.zeros(len(words)), logs)).sum() + 10**alone.end
    assert 0.9999 < total <= 1 + 1e-9


def plain_scores(rows):
    """Base scores and counts in plain Python."""
    held = {k: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for k, (i, _) in enumerate(rows)}
    split = [(t or "").encode().lower().split() for _, t in rows]
    counts, n_train = Counter(), 0
    for k, words in enumerate(split):
        if not held[k]:
            counts.update(words)
            n_train += 1
    N, V = sum(counts.values()) + n_train, len(counts) + (n_train > 0)
    value = lambda c: math.log10((c + 0.1) / (N + 0.1 * (V + 1)))
    return [(i, held[k], len(w) + 1, sum(counts[x] > 0 for x in w) + (n_train > 0), N, sum(value(counts[x]) for x in w) + value(n_train))
            for k, ((i, _), w) in enumerate(zip(rows, split))]


def plain_model_scores(rows, training, rounds):
    """The model's log10 probabilities, every segmentation of every word written out."""
    lat, prior = subword_lm.vocabulary(PATH)
    w = dict(zip(lat.pieces, prior)) | {None: prior[-1]}  # None: the end
    split = {i: (t or "").lower().split() for i, t in rows}
    ways = {x: [s for s in segmentations("▁" + x) if all(p in w for p in s)] for words in split.values() for x in words}
    counts = Counter(x for i, words in split.items() if i in training for x in words)
    for _ in range(rounds if training else 0):
        uses = {p: subword_lm.PRIOR * v for p, v in w.items()}
        for x in counts:
            weigh = [math.prod(w[p] for p in s) for s in ways[x]]
            for s, v in zip(ways[x], weigh):
                for p in s:
                    uses[p] += v / sum(weigh)
        uses[None] += 1
        whole = sum(uses.values())
        w = {p: v / whole for p, v in uses.items()}
    N, V = sum(counts.values()) + len(training), len(counts) + 1
    first = sum(v for p, v in w.items() if p and p.startswith("▁"))
    D = subword_lm.DISCOUNT

    def word(x):
        pieces = sum(math.prod(w[p] for p in s) for s in ways[x]) * (first + w[None]) / first
        return math.log10(max(counts[x] - D, 0) / N + D * V / N * pieces)

    return {i: sum(map(word, words)) + math.log10((len(training) - D) / N) for i, words in split.items()}


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_model_score_equals_all_segmentations(spark, rounds):
    """``score`` itself on documents: prior, expectation rounds, whole-word arcs, discount and end, by plain enumeration."""
    rows = [(1, "The cat sat on the mat and the cat ran"), (2, "a dog sat"), (3, "zebra cats run on mats"), (4, ""), (5, None),
            (6, "the xqzv dog"), (7, "The cat sat on the mat and the cat ran")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    training = {1, 2, 4, 7}
    want = plain_model_scores(rows, training, rounds)
    got = subword_lm.score(docs, F.col("doc_id").isin(*training), PATH, rounds=rounds, block_bytes=40).collect()
    assert {r.doc_id: r.score for r in got} == pytest.approx(want, rel=1e-9)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[5]))


@pytest.mark.parametrize("block_bytes", [1 << 20, 20_000])
def test_scores_odd_rows(odd, block_bytes):
    got = ordered(subword_lm.score(odd, id_crc("doc_id") % 10 != 0, PATH, block_bytes=block_bytes).collect())
    for g, e in zip(got, ordered(plain_scores(ODD)), strict=True):
        assert tuple(g[:5]) == tuple(e[:5]) and g.base_score == pytest.approx(e[5], rel=1e-9)
        assert g.score < 0 and math.isfinite(g.score)


def test_scores_table(spark, none):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    train = id_crc("doc_id") % 10 != 0
    got = ordered(subword_lm.score(docs, train, PATH, block_bytes=60_000).collect())
    again = ordered(subword_lm.score(docs, train, PATH).collect())
    for g, a, e in zip(got, again, ordered(plain_scores([(r.doc_id, r.text) for r in docs.collect()])), strict=True):
        assert tuple(g[:5]) == tuple(e[:5]) and g.base_score == pytest.approx(e[5], rel=1e-9)
        assert g.score == pytest.approx(a.score, rel=1e-9)
    prior = ordered(subword_lm.score(docs, train, PATH, rounds=0).collect())
    held = lambda rows: sum(r.score for r in rows if r.held_out)
    assert held(got) > held(prior)  # what is learned from the training texts helps on the others
    assert subword_lm.score(none, train, PATH).count() == 0


def test_scores_without_training_rows(odd):
    rows = subword_lm.score(odd, F.lit(False), PATH).collect()
    assert len(rows) == len(ODD) and all(r.held_out and r.n_known == 0 and r.train_tokens == 0 for r in rows)


# --- codec ---------------------------------------------------------------


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(*parts):
    out = b""
    for number, v in parts:
        if isinstance(v, float):
            out += varint(number << 3 | 5) + struct.pack("<f", v)
        elif isinstance(v, int):
            out += varint(number << 3) + varint(v)
        else:
            v = v.encode() if isinstance(v, str) else v
            out += varint(number << 3 | 2) + varint(len(v)) + v
    return out


def unigram_model(byte_fallback, extra_spaces):
    """A small unigram model written by hand."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        pieces += [(f"<0x{b:02X}>", -20.0, 6) for b in range(256)]
    pieces += [(p, -1.5 - k / 7, 1) for k, p in enumerate(
        ["▁", "▁the", "t", "h", "e", "he", "▁t", "r", "re", "▁a", "a", "n", "nd", "▁and", "d", "an", "ther", "s", "o", "ft", "é"])]
    return message(*((1, message((1, p), (2, s), (3, k))) for p, s, k in pieces),
                   (2, message((3, 1), (35, int(byte_fallback)))), (3, message((1, "identity"), (3, 1), (4, int(extra_spaces)), (5, 1))))


TEXTS = ["the other and the heather", "  the   rest ", "", " ", "don't ø 日本", "the\nand\tthe", "▁the", "and", "e" * 40, "sandre thér"]


@pytest.mark.parametrize("byte_fallback", [False, True])
@pytest.mark.parametrize("extra_spaces", [False, True])
def test_unigram_parity(byte_fallback, extra_spaces):
    raw = unigram_model(byte_fallback, extra_spaces)
    theirs = sentencepiece.SentencePieceProcessor(model_proto=raw)
    codec = sp_codec.Codec(raw, check=True)
    ids, _, same = codec.checked([t.encode() for t in TEXTS])
    ids = [np.frombuffer(x, "<u4").tolist() for x in ids]
    assert set(same) <= {True, None} and True in same and (codec.parted or None not in same)
    assert ids == theirs.encode(TEXTS)
    if byte_fallback:
        assert codec.decode([np.array(i) for i in ids]) == theirs.decode(ids)


def test_model_file():
    model, theirs = parse_model(open(PATH, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert [(p, s) for p, s, _ in model.pieces] == [(theirs.id_to_piece(k), theirs.get_score(k)) for k in range(theirs.get_piece_size())]
    assert (model.model_type, model.byte_fallback, model.add_dummy_prefix, model.remove_extra_whitespaces) == (2, True, True, False)


def test_digests_measure_parity_on_every_text(spark):
    """Each row of the query has its own parity; encode measures a share, unless it is told otherwise."""
    docs = spark.createDataFrame([(k, f"some words {k}, and more of them\n\n{k * 7919} ") for k in range(64)] + [(64, None), (65, "")], "doc_id long, text string")
    rows = sp_codec.digests(docs, PATH).collect()
    assert len(rows) == 66 and all(r.parity_measured and r.parity and r.round_trip for r in rows)
    assert any(r.parity is None for r in sp_codec.encode(docs, PATH, check=True).collect())
    codec = sp_codec.Codec(open(PATH, "rb").read(), check=True, share=1)
    codec.judge = sentencepiece.SentencePieceProcessor(model_file=PATH, add_bos=True)  # a library that differs is noticed on each text
    assert codec.checked([b"one", b"two words", b"three of them"])[2] == [False] * 3


def test_merge_parity(spark, odd, none):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    rows = sp_codec.encode(docs, PATH, check=True).collect()
    texts = sorted((r.text or "") for r in docs.collect())
    assert len(rows) == len(texts) and all(r.parity is not False and r.round_trip for r in rows)
    assert 0 < sum(r.parity is True for r in rows) < len(rows)
    assert all((r.parity is not None) == r.parity_measured for r in sp_codec.digests(odd, PATH).collect())
    theirs = sentencepiece.SentencePieceProcessor(model_file=PATH)
    codec = sp_codec.Codec(open(PATH, "rb").read(), cache=40, check=True)
    odd_texts = [*texts, *TEXTS, "a  b", "x \n y", "\n\n", "tail  ", " lead", "▁▁ x▁y ", "\n▁", "a\n \nb", "▁"]
    for t in odd_texts:
        ids, back, same = codec.checked([t.encode()])
        assert np.frombuffer(ids[0], "<u4").tolist() == theirs.encode(t) and same in ([True], [None]), t
        assert back == [theirs.decode(theirs.encode(t)) == t], t
        assert codec.decode([np.frombuffer(ids[0], "<u4")]) == [theirs.decode(theirs.encode(t))], t
    whole = codec.encode([t.encode() for t in odd_texts])  # all at once
    assert [np.frombuffer(x, "<u4").tolist() for x in whole] == theirs.encode(odd_texts)
    # a difference shows where whole texts are asked
    codec = sp_codec.Codec(open(PATH, "rb").read(), check=True)
    codec.judge = type("Other", (), {"encode": lambda self, x: [[0] for _ in x]})()
    same = codec.checked([f"text number {k}".encode() for k in range(200)])[2]
    assert set(same) == {False, None} and 0 < same.count(False) < 50
    # every text's own ids are decoded
    codec = sp_codec.Codec(open(PATH, "rb").read(), check=True)
    decoder = codec.whole
    codec.whole = type("Other", (), {"decode_batch": lambda self, x, **o: [t + "x" * ("bad" in t) for t in decoder.decode_batch(x, **o)]})()
    assert codec.checked([b"good", b"bad", b"", b"good bad"])[1] == [True, False, True, False]
    assert sp_codec.encode(none, PATH).count() == 0


def test_new_stretches_go_to_the_model_alone():
    """Stretches that were not met go to the model, each once, without the pipeline; decoding runs no pattern over each piece; results are the pipeline's."""
    codec = sp_codec.Codec(open(PATH, "rb").read(), threads=1)
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("theandsr\u00e9,.7"), rng.integers(4, 14))) for _ in range(20_000)})
    stretches = [f" {w}".encode() for w in words] + [b"  \n", b"\n\n", b"after", b"   ", "\u2581 \u2581the".encode(), "\U0001f9ff\u0301".encode(), b"<s>", b" <0x41>", b"\xff"]
    plain = [s.decode("utf-8", "replace") for s in stretches]
    pipeline = sp_codec.build(codec.model, prefix=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in codec._learn(stretches)] == [e.ids for e in pipeline.encode_batch_fast(plain, add_special_tokens=False)]
    assert codec.inner is None  # no pipeline for them is there
    core, asked = codec.core, []
    codec.core = type("Counted", (), {"tokenize": lambda self, x: asked.append(x) or core.tokenize(x)})()
    texts = [" ".join(words[k : k + 200]) for k in range(0, len(words), 200)]
    ids = [np.frombuffer(x, "<u4").tolist() for x in codec.encode([t.encode() for t in texts])]
    assert codec.encode([t.encode() for t in texts[::-1]]) and sorted(asked) == sorted(f"\u2581{w}" for w in words)
    slow = sp_codec.build(codec.model)
    slow.decoder = decoders.Sequence([decoders.Replace("\u2581", " "), decoders.ByteFallback(), decoders.Fuse(), decoders.Strip(" ", 1, 0)])
    decode = lambda t: t.decode_batch(ids, skip_special_tokens=False)
    assert decode(codec.whole) == decode(slow) == texts
    assert "Replace" not in {step["type"] for step in json.loads(codec.whole.to_str())["decoder"]["decoders"]}
    # ids that no text has: a marker spelt in bytes, control pieces, every piece of the model
    odd_ids = [[3 + 0xE2, 3 + 0x96, 3 + 0x81], [1, 2, 0], [], *([k] for k in range(len(codec.model.pieces)))]
    assert codec.whole.decode_batch(odd_ids, skip_special_tokens=False) == slow.decode_batch(odd_ids, skip_special_tokens=False)


@pytest.mark.parametrize("extra_spaces", [False, True])
def test_pieces_looked_for_first(extra_spaces):
    """Pieces that a user defined are found before the model is asked, also in stretches."""
    more = message((1, message((1, "ther"), (2, 0.0), (3, 4))))
    codec = sp_codec.Codec(unigram_model(True, extra_spaces) + more)
    assert codec.parted == (not extra_spaces)
    ids = [np.frombuffer(x, "<u4").tolist() for x in codec.encode([t.encode() for t in TEXTS])]
    assert ids == [e.ids for e in codec.whole.encode_batch_fast(TEXTS, add_special_tokens=False)]
    assert len(codec.model.pieces) - 1 in ids[0]


def test_decode_rows(spark, odd):
    rows = sp_codec.decode(sp_codec.encode(odd, PATH), PATH).collect()
    assert sorted(r.text for r in rows) == sorted(t or "" for _, t in ODD)
    null = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert sp_codec.decode(null, PATH).collect()[0].text is None


def test_long_words_in_stretches(monkeypatch):
    """Forward sums and expected uses of long words, cut into stretches, equal those of one step a character."""
    lat, weights = subword_lm.vocabulary(PATH)
    logs = subword_lm.log_weights(weights)
    rng = np.random.default_rng(6)
    for n in (130, 577, 1500):
        words = ["".join(rng.choice(list("theandsr\u00e9\U0001f9ff"), n)) for _ in range(2)]
        args = (lat, *subword_lm.arcs_of(lat, words), logs)
        monkeypatch.setattr(subword_lm, "LONG", 1 << 30)
        alpha, uses = subword_lm.forward(*args)[0], subword_lm.expected(*args, np.array([1.0, 2.0]))
        monkeypatch.setattr(subword_lm, "LONG", 50)
        assert np.allclose(subword_lm.forward(*args)[0], alpha, rtol=1e-10)
        assert np.allclose(subword_lm.expected(*args, np.array([1.0, 2.0])), uses, rtol=1e-7, atol=1e-9)


def test_word_of_a_megabyte():
    import time
    lat, weights = subword_lm.vocabulary(PATH)
    word = "".join(np.random.default_rng(7).choice(list("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/"), 1_000_000))
    began = time.time()
    got = subword_lm.word_logs(lat, [word.encode()], subword_lm.log_weights(weights))[0]
    assert np.isfinite(got) and got < -100_000 and time.time() - began < 90
