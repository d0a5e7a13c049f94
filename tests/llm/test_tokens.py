import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedcheck.llm import bpe, packing, tokenfiles
from feedcheck.llm.queries import tokenizer_file

ODD = ["", "a", "  a  b", "a\n\nb", "a \n b\n", "it's THEY'RE'll", "\x1c x\x1d\x85y\u3000z", "e\u0301 \u0391\u03a3 \u0130I", "<|endoftext|>a <|endoftext|> b\n", "a" * 500,
       "12345 \uff16 \u00b2\u00bd", "\u65e5\u672c \ud55c\uad6d", "\U0001f600 \U0001f600!!??..", "\ttab\tt\n\tx", "\x00 a\x00b", "a\u00a0b", "a.b,c .d ,e ,, f.. g_.h 3.14, 1,000.", ". a", "x.'s"]
FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.fixture(scope="module")
def made():
    return {f: (Tokenizer.from_file(tokenizer_file(f)), bpe.Codec(tokenizer_file(f)), bpe.Codec(tokenizer_file(f), library=True)) for f in FILES}


@pytest.mark.parametrize("file", FILES)
def test_codecs_equal_the_library(made, file):
    lib, own, memo = made[file]

    @settings(max_examples=300, deadline=None)
    @given(st.one_of(st.sampled_from(ODD), st.text(max_size=40), st.text("ab .,\n'sé1!_\u0301", max_size=60)))
    def same(text):
        want = lib.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == want == memo.encode(text).tolist()
        machine = own.decoder()
        assert "".join(machine.push([i]) for i in want) + machine.close() == lib.decode(want, skip_special_tokens=False)

    same()


def around(c):
    return f":{c}", f"a{c}b 1{c} .{c},{c} x", f"a.{c}b,{c}", f"{c}'s{c}.\n {c}, a\u0316{c}\u0301e\u0301{c}\u0316", f"A{c} É{c}\U00011935{c}  {c}<|endoftext|>{c}"


@pytest.mark.parametrize("file", FILES)
def test_code_points_of_late_unicode_versions_and_separators(made, file):
    lib, own, memo = made[file]
    late = ["\U00018d80", "\U0003d000", "\u0558", "\U000187ff", "\U00012550", "\u1c89", "\ua7cb", "\ua7ce", "\u07fd", "\u0898", "\U0001e4ec", "\U00011930"]
    for c in [*late, *map(chr, range(0x1C, 0x20)), *(chr(c) for c in range(0xA0, 0x110000, 997) if not 0xD800 <= c < 0xE000)]:
        for text in around(c):
            want = lib.encode(text, add_special_tokens=False).ids
            assert own.encode(text).tolist() == want == memo.encode(text).tolist(), ascii(text)


@pytest.mark.parametrize("file", FILES)
def test_code_points_on_which_unicode_tables_differ(made, file):
    lib, own, memo = made[file]
    for text in (t for c in sorted(bpe.odd_code_points()[0])[::40] for t in around(c)):
        want = lib.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == want == memo.encode(text).tolist(), ascii(text)


def test_texts_without_such_code_points_need_no_library(made, monkeypatch):
    own = made["word_bpe_49k.json"][1]
    monkeypatch.setattr(own, "_by_library", None)
    assert [own.normalise(t) for t in ("ÉA\u0301 x", "\U0001f600 Ü", "日本 Σ")] == ["éá x", "\U0001f600 ü", "日本 σ"]
    assert not any(map(own._is_odd, ("ÉA\u0301 x", "\U0001f600 Ü", "日本 Σ", "")))


def test_long_words_are_emitted_before_they_end(made):
    own = made["word_bpe_49k.json"][1].transducer
    for word in ("ab" * 4000, "a" * 5000, "thandingerest" * 300):
        read = 0

        def letters():
            nonlocal read
            for c in word:
                read += 1
                yield c

        stream = own.encode(letters())
        first = next(stream)
        assert read < 8 * own.lookahead + 8
        assert [first, *stream] == own.encode_short(word[:]) if len(word) < 900 else True
    short = "thandinger" * 20
    assert list(own.encode(short)) == own.encode_short(short) == own.merged([own.vocab[c] for c in short[:-1]] + [own.vocab[short[-1] + "</w>"]])


def test_every_word_streams(made, monkeypatch):
    own = made["word_bpe_49k.json"][1]
    for word in ("thandingerest" * 5, "ab" * 50, "xqzj" * 20):
        read = []
        stream = own.transducer.encode(read.append(c) or c for c in word)
        first = next(stream)
        assert len(read) < len(word)
        assert [first, *stream] == own.transducer.merged([own.vocab[c] for c in word[:-1]] + [own.vocab[word[-1] + "</w>"]])
    seen, encode = [], own.transducer.encode
    monkeypatch.setattr(own.transducer, "encode", lambda letters: encode(seen.append("".join(letters)) or [seen[-1]]))
    own.encode("brevityqx oddwordlyx")
    assert seen == ["brevityqx", "oddwordlyx"]


DOCS = [(5, "b c"), (1, "a"), (None, "n"), (3, None), (3, ""), (9, "word " * 30_000), (2, "Ünï <|endoftext|>"), (5, "a c")]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, start int")


def test_record_files_round_trip(spark):
    file = "byte_bpe_50k.json"
    lib = Tokenizer.from_file(tokenizer_file(file))
    folder = tokenfiles.write_token_files(docs_of(spark, DOCS), tokenizer_file(file), 2)
    index = tokenfiles.read_index(spark, folder)
    start, want = 0, []
    for i, t in sorted(DOCS, key=lambda r: (-1 if r[0] is None else r[0], r[1] is not None, r[1] or "")):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, tokenfiles.sequence_digests(index).collect()), key=str) == sorted(want, key=str)
    some = tokenfiles.read_sequences(index.filter("doc_id = 2").orderBy("start")).collect()
    assert some[0].ids == lib.encode(DOCS[6][1], add_special_tokens=False).ids + [2]
    empty = tokenfiles.write_token_files(docs_of(spark, []), tokenizer_file(file), 2)
    assert tokenfiles.sequence_digests(tokenfiles.read_index(spark, empty)).count() == 0


def test_damage_is_noticed(tmp_path):
    record = tokenfiles.frame(b"abcd")
    for k in range(len(record)):
        (tmp_path / "r").write_bytes(record[:k] + bytes([record[k] ^ 1]) + record[k + 1 :])
        with open(tmp_path / "r", "rb") as f, pytest.raises(ValueError):
            tokenfiles.read_frame(f)


def test_coding_digests(spark):
    file = "word_bpe_49k.json"
    lib = Tokenizer.from_file(tokenizer_file(file))
    want = []
    for i, t in DOCS:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe.coding_digests(docs_of(spark, DOCS), tokenizer_file(file)).collect()), key=str) == sorted(want, key=str)
    encoded = bpe.encode_texts(docs_of(spark, DOCS[:2]), tokenizer_file(file))
    assert {r.doc_id: r.text for r in bpe.decode_ids(encoded, tokenizer_file(file)).collect()} == {5: "b</w> c</w>", 1: "a</w>"}
    assert bpe.coding_digests(docs_of(spark, []), tokenizer_file(file)).count() == 0


def test_pieces_hold_each_id_once(spark):
    file = "word_bpe_49k.json"
    lib = Tokenizer.from_file(tokenizer_file(file))
    rows = [(i, ("some words here. and more, " * (i % 37 * 5)) + str(i)) for i in range(400)] + [(None, "x"), (7, None), (400, "long " * 20_000)]
    got = packing.pack_documents(docs_of(spark, rows), tokenizer_file(file), 2, size=256).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, t in rows:
        if i != 7:
            ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
            at = 0
            for r in sorted(by_doc[i], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
    pad = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 256
        pad, total = pad + packing.padding(at, 256), total + at
    assert pad < 0.05 * total
    assert packing.pack_documents(docs_of(spark, []), tokenizer_file(file), 2).count() == 0


def test_windows_are_the_best():
    rng = np.random.default_rng(1)
    size = 16
    for _ in range(200):
        at = np.unique(rng.integers(1, 60, rng.integers(1, 12))).tolist()
        at = sorted({*at, *range(at[0] % size or 1, at[-1], size - 3)})
        cost = [int(c) for c in rng.choice([0, 8, 24], len(at) - 1)] + [0]
        pad = lambda n: 0 if n in (size, size // 2, size // 4) else size - n  # noqa: E731  the lengths that are looked for
        best = {0: 0}
        price = dict(zip(at, cost))
        for p in at:
            best[p] = min((best[q] + pad(p - q) + price[p] for q in best if 0 < p - q <= size), default=10**9)
        end = at[-1]
        tails = [best[q] + packing.INSIDE * (bin(end - q).count("1") - 1) for q in best if 0 < end - q <= size and q != end]
        if min(best[end], *tails) >= 10**9:
            continue
        cuts = packing.windows(at, cost, size)
        assert cuts[-1] == end and all(0 < b - a <= size for a, b in zip([0, *cuts], cuts))
        paid = sum(packing.padding(b - a, size) for a, b in zip([0, *cuts], cuts)) + sum(price.get(c, packing.INSIDE) for c in cuts[:-1])
        assert paid <= min(best[end], *tails)


def test_every_sentence_end_is_a_candidate():
    at, cost = packing.candidates(150, np.array([3, 10, 20, 40, 130, 149, 150]), 32)
    assert at.tolist() == [3, 10, 20, 40, 96, 128, 130, 149, 150]
    assert cost.tolist() == [packing.SENTENCE] * 4 + [packing.INSIDE] * 2 + [packing.SENTENCE] * 2 + [0]
    assert packing.candidates(3, np.array([], int), 32)[0].tolist() == [3]
