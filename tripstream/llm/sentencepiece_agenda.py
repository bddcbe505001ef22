"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text becomes symbols, one per character, with blanks written as U+2581 and one
put in front. An agenda (a heap) holds every adjacent pair of symbols whose
concatenation is a piece, highest score first and leftmost first among equals;
the top pair is merged and its new neighbours enter the agenda, until it is
empty. Symbols without a piece become byte pieces.

Where no piece has a blank after another character, a text's words are encoded
independently, so the distinct words of a batch are encoded once; other
vocabularies take whole texts. Every distinct word is checked against the
sentencepiece library, and a difference stops the job; a worker keeps the ids of
words that it has checked (``KNOWN_BYTES`` of them) for its later batches.

The model file is a path that exists on every worker. Null and empty texts have
no ids and decode to the empty text. Repeated rows are encoded one by one; input
columns named like an output are replaced; an empty table gives an empty one. A
very long word takes some ten microseconds and 200 bytes a character in its task.
"""

from __future__ import annotations

import functools
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import map_texts, strings_between, text_bytes

BLANK = "▁"
NORMAL, UNKNOWN, BYTE, USER, UNUSED = 1, 2, 6, 4, 5


#: Memory for words that a worker has encoded and checked, by an estimate.
KNOWN_BYTES = 56 << 20


class MergeVocabulary:
    """Pieces, scores and decoding of a merge-type model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces \
                or not norm.add_dummy_prefix or not norm.escape_whitespaces \
                or any(p.type in (USER, UNUSED) for p in model.pieces):
            raise ValueError("only merge-type models with identity normalization are supported")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unknown = model.trainer_spec.unk_id
        self.ids, self.scores, self.byte_ids, self.bytes = {}, {}, [0] * 256, []
        for i, p in enumerate(model.pieces):
            if p.type == NORMAL:
                self.ids[p.piece], self.scores[p.piece] = i, p.score
                self.bytes.append(p.piece.replace(BLANK, " ").encode())
            elif p.type == BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.bytes.append(bytes([int(p.piece[3:5], 16)]))
            else:
                self.bytes.append(" ⁇ ".encode() if p.type == UNKNOWN else b"")
        self.known: dict[bytes, list[int]] = {}
        self.room = KNOWN_BYTES
        self.by_word = not any(b != BLANK and a == BLANK for p in self.ids for b, a in zip(p, p[1:]))

    def keep(self, word: bytes, ids: list[int]) -> None:
        """Remember the checked ids of a word for later batches of this worker, up to
        ``KNOWN_BYTES`` in all; the words that come first stay."""
        size = len(word) + 8 * len(ids) + 200
        if size <= self.room:
            self.known[word] = ids
            self.room -= size

    def encode_symbols(self, text: str) -> list[int]:
        """Ids of a text whose blanks are written as U+2581, by the agenda."""
        symbols: list[str] = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        scores, agenda = self.scores, []
        for i in range(n - 1):
            score = scores.get(symbols[i] + symbols[i + 1])
            if score is not None:
                agenda.append((-score, i, i + 1, symbols[i] + symbols[i + 1]))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            # a symbol that was merged away is empty, one that grew is longer
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(piece):
                continue
            symbols[left], symbols[right] = piece, ""
            far = after[right]
            after[left] = far
            if far < n:
                before[far] = left
                score = scores.get(piece + symbols[far])
                if score is not None:
                    heapq.heappush(agenda, (-score, left, far, piece + symbols[far]))
            near = before[left]
            if near >= 0:
                score = scores.get(symbols[near] + piece)
                if score is not None:
                    heapq.heappush(agenda, (-score, near, left, symbols[near] + piece))
        out: list[int] = []
        for s in symbols:
            if s:
                found = self.ids.get(s)
                if found is None:
                    out.extend(self.byte_ids[b] for b in s.encode())
                else:
                    out.append(found)
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return self.encode_symbols((" " + text).replace(" ", BLANK)) if text else []

    def decode_pieces(self, ids: list[int]) -> str:
        """Text of the pieces, the leading blank included; bytes that are not
        UTF-8 become U+FFFD one by one."""
        whole = b"".join([self.bytes[i] for i in ids])
        try:
            return whole.decode()
        except UnicodeDecodeError:
            return _decode_lenient(whole)

    def decode(self, ids: list[int]) -> str:
        """Text of the ids, without the blank that encoding puts in front."""
        text = self.decode_pieces(ids)
        first = next((i for i in ids if self.bytes[i]), None)
        return text if first == self.unknown else text.removeprefix(" ")


def _decode_lenient(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> MergeVocabulary:
    return MergeVocabulary(path)


def _words(vocab: MergeVocabulary, text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words as a dictionary array, first word of each text and the end)."""
    if pa.types.is_large_string(text.type):
        text = text.cast(pa.string())
    text = pc.fill_null(text, "")
    marked = pc.binary_join_element_wise("", text, " ")
    text = pc.replace_substring(pc.if_else(pc.equal(text, ""), "", marked), BLANK, " ")
    data, ends = text_bytes(text)
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    if vocab.by_word and n:
        cut[:n] = data == 0x20
        cut[1:n] &= data[:-1] != 0x20
    cut[ends] = True
    cuts = np.flatnonzero(cut)
    return strings_between(data, cuts).dictionary_encode(), np.searchsorted(cuts, ends)


def encode_batch(vocab: MergeVocabulary, text: pa.Array, check: bool = True):
    """(ids of each distinct word, word numbers, first word of each text)."""
    words, first = _words(vocab, text)
    raw = words.dictionary.to_pylist()
    ids = [vocab.known.get(w) for w in raw]
    new = [k for k, found in enumerate(ids) if found is None]
    unique = [raw[k].decode() for k in new]
    for k, w in zip(new, unique):
        ids[k] = vocab.encode_symbols(w.replace(" ", BLANK))
    if check:
        # the library puts the leading blank itself, and has no ids for nothing
        both = [(k, w) for k, w in zip(new, unique) if len(w) > 1]
        theirs = vocab.library.encode([w[1:] for _, w in both], out_type=int, num_threads=1)
        for (k, w), expected in zip(both, theirs):
            if ids[k] != expected:
                raise ValueError(f"agenda and library differ on {w!r}: {ids[k]} and {expected}")
        for k in new:
            vocab.keep(raw[k], ids[k])
    return ids, words.indices.to_numpy(), first


def encode_documents(docs: DataFrame, model_path: str, text_col: str = "text", check: bool = True,
                     with_ids: bool = True, with_text: bool = True,
                     keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by
    commas) and ``decoded_sha256`` (of the decoded text in UTF-8); ``ids`` and
    ``decoded`` themselves if asked for."""
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    fields += ", ids array<int>" * with_ids + ", decoded string" * with_text

    def make():
        vocab = vocabulary(model_path)

        def work(text):
            ids, number, first = encode_batch(vocab, text, check)
            size = np.array([len(x) for x in ids], dtype=np.int64)
            shown = [",".join(map(str, x)) for x in ids]
            plain = [vocab.decode_pieces(x) for x in ids]
            counts, id_hash, text_hash, texts = [], [], [], []
            order = number.tolist()
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                own = order[a:b]
                counts.append(int(size[number[a:b]].sum()))
                id_hash.append(hashlib.sha256(",".join([shown[k] for k in own]).encode()).hexdigest())
                decoded = "".join([plain[k] for k in own]).removeprefix(" ")
                text_hash.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_text:
                    texts.append(decoded)
            out = [pa.array(counts, pa.int64()), pa.array(id_hash, pa.string()), pa.array(text_hash, pa.string())]
            if with_ids:
                flat = np.array([i for x in ids for i in x], dtype=np.int32)
                begin = np.r_[0, np.cumsum(size)][number]
                ends = np.r_[0, np.cumsum(counts)].astype(np.int32)
                own = size[number]
                at = np.repeat(begin - (np.cumsum(own) - own), own) + np.arange(own.sum())
                out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[at])))
            if with_text:
                out.append(pa.array(texts, pa.string()))
            return out
        return work

    return map_texts(docs, text_col, fields, make, keep, step_bytes=12 << 20)
