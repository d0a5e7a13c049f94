"""Byte-pair encoding as a streaming transducer, and decoding as a state machine.

The ids of a tokenizer file are computed here, without the tokenizer library. The encoder
rests on a property of merge lists in which a pair is merged only after its parts are made:
a sequence of tokens is the encoding of its text if and only if each two neighbours are the
encoding of theirs. So the encoding of a prefix is the encoding of a shorter prefix plus one
token, and that token reaches back no further than the longest token is long. Only that many
prefixes can still be continued; tokens on which all of them agree are final.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedcheck.llm.common import Memo, record_batches, small_batches

#: Split pattern of the byte-level set-up that names none. Fixed value.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space that touches white space.
_TWO_SPACES = re.compile(r"\s\s")
#: A stop or comma that touches another mark, so that the two may form one word; and the same or one after white space.
#: The four separators are white space to Python and marks to tokenizer files.
_MARKS = re.compile(r"[.,](?:(?=[^\w\s]|[_\x1c-\x1f])|(?<=[^\w\s].)|(?<=[_\x1c-\x1f].))")
_SPACED_MARKS = re.compile(r"[.,](?:(?=[^\w\s]|[_\x1c-\x1f])|(?<=\W.)|(?<=_.))")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where printable, else the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


#: Planes of characters; those above hold none that is a letter, number or mark with an order.
_PLANES = 0x40000


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


@cache
def odd_code_points() -> tuple[frozenset[str], re.Pattern, dict[int, str]]:
    """Code points that the Unicode tables of the ``tokenizers`` library treat otherwise than those of Python or of
    the ``regex`` module, by class, lower case or normal form; a quick pattern, which each of them fits; and for those
    of another class a code point of the class that the library has them in."""
    from tokenizers import Regex, normalizers

    every = np.delete(np.arange(_PLANES, dtype="<u4"), slice(0xD800, 0xE000)).tobytes().decode("utf-32-le")
    letters, numbers = (_codes(normalizers.Replace(Regex(rf"[^\p{{{k}}}]+"), "").normalize_str(every)) for k in "LN")
    differ = [np.setxor1d(ours, _codes(regex.sub(rf"[^\p{{{k}}}]+", "", every))) for k, ours in (("L", letters), ("N", numbers))]
    words = np.setdiff1d(_codes(re.sub(r"[\W_]+", "", every)), np.concatenate([letters, numbers]))
    classed = np.unique(np.concatenate([*differ, words]))
    stand_ins = {c: "\u4e00" if a else "\u0660" if n else "\uffff" for c, a, n in zip(classed.tolist(), np.isin(classed, letters), np.isin(classed, numbers))}
    lower, nfc = normalizers.Lowercase().normalize_str, normalizers.NFC().normalize_str
    odd = set(map(chr, stand_ins))
    for i in range(0, len(every), 4096):
        piece = every[i : i + 4096]
        if lower(piece) != piece.lower():
            odd.update(c for c in piece if lower(c) != c.lower())
    # Marks between marks of two classes show their own class; parts show whether they are joined.
    probes = [(c, f"a\u0316{c}\u0301b\u0301{c}\u0316") for c in regex.findall(r"\p{M}", every)]
    parts = ["".join(chr(int(x, 16)) for x in d.split()) for d in map(unicodedata.decomposition, every) if d and d[0] != "<"]
    for which, probe in chain(probes, zip(parts, parts)):
        if nfc(probe) != unicodedata.normalize("NFC", probe):
            odd.update(which)
    return frozenset(odd), re.compile("[" + "".join(re.escape(c) for c in sorted(odd) if c <= "\uffff") + "\U00010000-\U0010ffff]"), stand_ins


class Transducer:
    """Streaming encoder of one word of byte letters under a merge list."""

    def __init__(self, vocab: dict[str, int], merges: Iterable, suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ", 1)) for m in merges]
        self.ranks = {(vocab[a], vocab[b]): (n, vocab[a + b]) for n, (a, b) in reversed(list(enumerate(pairs)))}
        self.symbols: dict[int, list[int]] = {}
        longest = max((len(a + b) - (len(suffix) if suffix and b.endswith(suffix) else 0) for a, b in pairs), default=1)
        #: Letters that may follow a prefix before its last tokens are known: no token is longer.
        self.lookahead = longest
        self.names = {i: t for t, i in vocab.items()}
        self._agrees: dict[tuple[int, int], bool] = {}
        #: Tokens by their letters from the last one on: those that end a word, and the others.
        self.ends: dict[str, dict] = {"": {}, suffix: {}}
        for name, token in vocab.items():
            final = suffix if suffix and name.endswith(suffix) and len(name) > len(suffix) else ""
            branch = self.ends[final]
            for letter in reversed(name.removesuffix(final)):
                branch = branch.setdefault(letter, {})
            branch[""] = token

    def _letters(self, token: int) -> list[int]:
        if token not in self.symbols:
            name, suffix = self.names[token], self.suffix
            final = suffix and name.endswith(suffix) and len(name) > len(suffix)
            letters = list(name.removesuffix(suffix)) if final else list(name)
            if final:
                letters[-1] += suffix
            self.symbols[token] = [self.vocab[x] for x in letters]
        return self.symbols[token]

    def merged(self, symbols: list[int]) -> list[int]:
        """The encoding of a short list of symbols, by the definition: the pair of least rank first."""
        symbols = list(symbols)
        while len(symbols) > 1:
            rank, new = min((self.ranks.get(p, (1 << 60, -1)) for p in zip(symbols, symbols[1:])))
            if new < 0:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and self.ranks.get((symbols[i], symbols[i + 1]), (-1, -1))[0] == rank:
                    out.append(new)
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def agrees(self, a: int, b: int) -> bool:
        """Whether ``a`` then ``b`` is the encoding of their text; ``a`` < 0 is the start of a word."""
        known = self._agrees.get((a, b))
        if known is None:
            left = [a] if a >= 0 else []
            known = self.merged((self._letters(a) if a >= 0 else []) + self._letters(b)) == [*left, b]
            if len(self._agrees) > 1_000_000:
                self._agrees.clear()
            self._agrees[a, b] = known
        return known

    def _step(self, word: str, base: int, p: int, ending: str, last: dict[int, int]) -> tuple[int, int]:
        """Token that ends the encoding of the first ``p`` letters, and where it starts."""
        branch = self.ends[ending]
        for q in range(p - 1, base - 1, -1):
            branch = branch.get(word[q - base])
            if branch is None:
                break
            if "" in branch and q in last and self.agrees(last[q], branch[""]):
                return q, branch[""]
        raise ValueError("a letter is not in the vocabulary")

    def encode(self, letters: Iterable[str]) -> Iterator[int]:
        """Ids of one word, given as letters or strings of letters; each is emitted as soon as all
        prefixes that a token can still continue agree on it. What is held does not grow with the word."""
        window, base, p = "", 0, 0
        # Of each prefix held: its last token, where that starts, and the prefixes that go on from it.
        last, back, onward = {0: -1}, {}, {0: set()}
        for letter in chain.from_iterable(letters):
            if window:
                # The letter held back turns out not to be the word's last one.
                p += 1
                back[p], last[p] = self._step(window, base, p, "", last)
                onward[back[p]].add(p)
                onward[p] = set()
                # No token reaches back to this prefix any more; it goes, and those that led to it alone.
                out = p - self.lookahead
                while out > base and out <= p - self.lookahead and not onward[out]:
                    before = back.pop(out)
                    onward[before].discard(out)
                    del last[out], onward[out]
                    out = before
                start = base
                while base <= p - self.lookahead and len(onward[base]) == 1:
                    (after,) = onward.pop(base)
                    del last[base], back[after]
                    yield last[after]
                    base = after
                window = window[base - start :]
            window += letter
        if window:
            n = base + len(window)
            back[n], last[n] = self._step(window, base, n, self.suffix, last)
            yield from self._path(n, back, last, base)

    def encode_short(self, word: str) -> list[int]:
        """The ids of a word held whole."""
        return list(self.encode((word,)))

    @staticmethod
    def _path(end: int, back: dict[int, int], last: dict[int, int], base: int) -> list[int]:
        out = []
        while end > base:
            out.append(last[end])
            end = back[end]
        return out[::-1]


class Codec:
    """Encoder and decoder of a byte-level BPE file.

    A text falls into units that cannot affect each other: at white space, where the file
    drops it, else before each space and around each line break, as long as no white space
    touches other white space; and around stops and commas that touch no other mark. The ids
    of recent units are remembered. Words are encoded by the transducer, or with ``library``
    by the model of the ``tokenizers`` library. A text that holds a code point on which Unicode
    tables differ is normalised by the library's normalisers and cut by its classes.
    """

    def __init__(self, path: str, library: bool = False):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or spec.get("post_processor"):
            raise ValueError("not a byte-level BPE file")
        if library:
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_file(path).model
        else:
            self.transducer = Transducer(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
            raise ValueError("unknown kind of added token")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        norms = spec.get("normalizer") or {}
        self.normalizers = norms.get("normalizers", [norms] if norms else [])
        if any(n["type"] not in ("NFC", "Lowercase", "Replace") or n["type"] == "Replace" and (n["pattern"], n["content"]) != ({"Regex": r"\s+"}, " ") for n in self.normalizers):
            raise ValueError("unknown normaliser")
        pres = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        split = next((p for p in pres if p["type"] == "Split"), None)
        if (split and (split["behavior"], split["invert"]) != ("Removed", True)) or pres[-1]["type"] != "ByteLevel" or pres[-1]["add_prefix_space"]:
            raise ValueError("unknown pre-tokenizer")
        self.drops = bool(split)
        self.pattern = regex.compile(split["pattern"]["Regex"] if split else BYTE_LEVEL_PATTERN)
        self.odd, self.maybe_odd, self.stand_ins = odd_code_points()
        self.letters = byte_letters()
        self.table = {b: x for b, x in enumerate(self.letters)}
        self.vocab = model["vocab"] | self.added
        self.names = {i: t for t, i in self.vocab.items()}
        self.kind = (spec.get("decoder") or {}).get("type")
        if self.kind not in (None, "ByteLevel"):
            raise ValueError("unknown decoder")
        #: Ids are packed in two bytes where they fit.
        self.dtype = np.dtype("<u2" if max(self.names) < 0x10000 else "<u4")
        self.by_library = library
        self.units = Memo(self._unit, limit=700_000, longest=48)

    def _is_odd(self, text: str) -> bool:
        return not text.isascii() and self.maybe_odd.search(text) is not None and not self.odd.isdisjoint(text)

    def _words(self, text: str) -> list[str]:
        if not self._is_odd(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.stand_ins))]

    def _unit(self, unit: str) -> bytes:
        words = self._words(unit)
        if words != [unit]:
            return b"".join(map(self.units.__getitem__, words))
        letters = unit if unit.isascii() and unit.isprintable() and " " not in unit else unit.encode().decode("latin-1").translate(self.table)
        if self.by_library:
            ids = [t.id for t in self.model.tokenize(letters)]
        else:
            ids = self.transducer.encode_short(letters)
        return np.array(ids, self.dtype).tobytes()

    def normalise(self, text: str) -> str:
        odd = bool(self.normalizers) and self._is_odd(text)
        for n in self.normalizers:
            if odd and n["type"] != "Replace":
                text = self._by_library(n["type"], text)
            elif n["type"] == "NFC":
                text = text if text.isascii() else unicodedata.normalize("NFC", text)
            elif n["type"] == "Lowercase":
                text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
            else:
                text = text if self.drops else regex.sub(r"\s+", " ", text)
        return text

    @staticmethod
    def _by_library(kind: str, text: str) -> str:
        from tokenizers import normalizers

        return getattr(normalizers, kind)().normalize_str(text)

    def _plain(self, text: str) -> bytes:
        """Ids of a text without added tokens; it falls into units that cannot affect each other."""
        text = self.normalise(text)
        odd = self._is_odd(text)
        if self.drops:
            if not odd and not _MARKS.search(text):
                text = text.replace(".", " . ").replace(",", " , ")
            return b"".join(map(self.units.__getitem__, text.replace("\n", " ").split(" ")))
        if odd or _TWO_SPACES.search(text) or "\0" in text:
            return b"".join(map(self.units.__getitem__, self._words(text)))
        if not _SPACED_MARKS.search(text):
            text = text.replace(".", "\0.\0").replace(",", "\0,\0")
        return b"".join(map(self.units.__getitem__, text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; null counts as empty."""
        if not text:
            return np.empty(0, self.dtype)
        if self.split_added is None or not any(t in text for t in self.added):
            return np.frombuffer(self._plain(text), self.dtype)
        parts = [np.array([self.added[x]], self.dtype).tobytes() if x in self.added else self._plain(x) for x in self.split_added.split(text)]
        return np.frombuffer(b"".join(parts), self.dtype)

    def decoder(self) -> Decoder:
        return Decoder(self)


class Decoder:
    """Ids to text, piece by piece: ``push`` returns what is certain so far, ``close`` the rest.
    State is a flag, or the bytes of one unfinished character."""

    def __init__(self, codec: Codec):
        self.codec, self.started = codec, False
        self.byte_of = {x: b for b, x in enumerate(codec.letters)}
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: Iterable[int]) -> str:
        names = [self.codec.names[i] for i in ids if i in self.codec.names]
        if self.codec.kind is None:
            # The file names no decoder: tokens as they are, a space between each two.
            text = " ".join(names)
            if self.started and names:
                text = " " + text
            self.started |= bool(names)
            return text
        data = b"".join(bytes(self.byte_of[c] for c in n) if all(c in self.byte_of for c in n) else n.encode() for n in names)
        return self.utf8.decode(data)

    def close(self) -> str:
        return self.utf8.decode(b"", True) if self.codec.kind else ""


_codecs: dict[tuple[str, bool], Codec] = {}


def codec(path: str, library: bool = False) -> Codec:
    """One codec for each worker process and file, kept between tasks."""
    if (path, library) not in _codecs:
        _codecs[path, library] = Codec(path, library)
    return _codecs[path, library]


DECODED_AT_ONCE = 1 << 16

_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
_DECODED = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))


def _pairs(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def encode_texts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ids (array of int) of each row's whole text (``doc_id``, ``text``). A null text
    has no ids; repeated rows and null ids give rows of their own; other columns are ignored."""

    def rows(batches):
        c = codec(tokenizer)
        return ((d, c.encode(t).tolist()) for d, t in _pairs(batches))

    return _texts(docs).mapInArrow(lambda b: record_batches(rows(b), _ENCODED, 64), "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and text of each row of ids (``doc_id``, ``ids``); null ids give the empty text."""

    def rows(batches):
        for d, ids in _pairs(batches):
            machine = codec(tokenizer).decoder()
            yield d, machine.push(ids or []) + machine.close()

    small_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(lambda b: record_batches(rows(b), _DECODED, 64), "doc_id long, text string")


def coding_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode each whole text and decode its ids again: doc_id, n_tokens, ids_sha256 (of the ids
    as little-endian unsigned 32-bit integers), decoded_sha256 (of the decoded text in UTF-8).
    Nothing is shuffled; null texts count as empty."""

    def rows(batches):
        c = codec(tokenizer)
        for d, text in _pairs(batches):
            ids, machine, decoded = c.encode(text), c.decoder(), hashlib.sha256()
            for i in range(0, len(ids), DECODED_AT_ONCE):
                decoded.update(machine.push(ids[i : i + DECODED_AT_ONCE].tolist()).encode())
            decoded.update(machine.close().encode())
            yield d, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), decoded.hexdigest()

    return _texts(docs).mapInArrow(lambda b: record_batches(rows(b), _DIGESTS), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
