"""Byte-level BPE as a monoid: encode the halves of a text, join neighbours.

The value of a stretch of text is its exact encoding as a text of its own. Two
neighbours are joined by encoding a window around their boundary anew. The window
grows to either side until the tokens outside cannot change:

* at a word boundary that the two characters beside it prove, whatever stands further
  off (``CERTAIN``), or
* inside a run of letters without such a boundary, at a pair of tokens that stays as it
  is when its bytes are encoded alone. A token sequence in which every neighbouring
  pair is of that kind is the encoding of its bytes.
"""

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from deskpulse.llm.common import column, kept

# Characters of a leaf of the tree.
LEAF = 8192
# Characters a window reaches at first, and before it looks at token pairs instead.
REACH = 32
WIDE = 1024
# Between the two characters of each kind every match of the word pattern ends: no match
# has white space after another character, and ASCII letters or digits end before
# ASCII punctuation.
CERTAIN = r"(?<=\S)(?=\s)|(?<=[A-Za-z0-9])(?=[!-/:-@\[-`{-~])"
TOKENIZER = "byte_bpe_50k.tiktoken"


class Codec:
    """A rank file with the word pattern it belongs to."""

    def __init__(self, path, pattern):
        import regex
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding(
            path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.token = {rank: token for token, rank in ranks.items()}
        self.certain = regex.compile(CERTAIN)
        self.letters = regex.compile(r"\p{L}+")

    def encode(self, text, leaf=LEAF):
        """Ids of a whole text."""
        return self._encode(text, 0, len(text), leaf)

    def _encode(self, text, start, end, leaf):
        if end - start <= leaf:
            return self.encoding.encode_ordinary(text[start:end])
        middle = (start + end) // 2
        left = self._encode(text, start, middle, leaf)
        right = self._encode(text, middle, end, leaf)
        return self.join(text, start, middle, end, left, right)

    def join(self, text, start, middle, end, left, right):
        """Encoding of text[start:end] from those of its two parts."""
        lo = self._before(text, start, middle)
        hi = self._after(text, middle, end)
        if hi - lo > 2 * WIDE and self.letters.fullmatch(text, lo + (text[lo] == " "), hi):
            return self._join_run(text, lo, middle, hi, left, right)
        window = self.encoding.encode_ordinary(text[lo:hi])
        self._drop_last(left, len(text[lo:middle].encode()))
        left += window
        left += right[self._count_first(right, len(text[middle:hi].encode())) :]
        return left

    def _before(self, text, start, middle):
        """The last certain boundary up to ``middle``, or ``start``."""
        reach = REACH
        while True:
            at = max(start, middle - reach)
            found = at
            # a boundary needs the character before it, which must not be cut off
            for match in self.certain.finditer(text, at + 1, min(middle + 1, len(text))):
                if match.start() <= middle:
                    found = match.start()
            if found > at or at == start:
                return found
            reach *= 2

    def _after(self, text, middle, end):
        """The first certain boundary from ``middle`` on, or ``end``."""
        reach = REACH
        while True:
            to = min(end, middle + reach)
            match = self.certain.search(text, max(middle, 1), min(to + 1, end))
            if match:
                return match.start()
            if to == end:
                return end
            reach *= 2

    def _drop_last(self, ids, n_bytes):
        while n_bytes > 0:
            n_bytes -= len(self.token[ids.pop()])
        assert n_bytes == 0, "a certain boundary lies within a token"

    def _count_first(self, ids, n_bytes):
        count = 0
        while n_bytes > 0:
            n_bytes -= len(self.token[ids[count]])
            count += 1
        assert n_bytes == 0, "a certain boundary lies within a token"
        return count

    def _join_run(self, text, lo, middle, hi, left, right):
        """Join inside one run of letters, which is one word to the encoder."""
        piece = self.encoding._encode_single_piece
        n_left = self._count_last(left, len(text[lo:middle].encode()))
        n_right = self._count_first(right, len(text[middle:hi].encode()))
        reach = 1
        while True:
            i, j = min(reach, n_left), min(reach, n_right)
            head, tail = len(left) - i, j
            raw = b"".join(self.token[t] for t in left[head:] + right[:tail])
            window = piece(raw)
            fits_left = i == n_left or self._stable(piece, left[head - 1], window[0])
            fits_right = j == n_right or self._stable(piece, window[-1], right[tail])
            if fits_left and fits_right:
                return left[:head] + window + right[tail:]
            reach *= 2

    def _count_last(self, ids, n_bytes):
        count = 0
        while n_bytes > 0:
            count += 1
            n_bytes -= len(self.token[ids[-count]])
        assert n_bytes == 0, "a certain boundary lies within a token"
        return count

    def _stable(self, piece, a, b):
        return piece(self.token[a] + self.token[b]) == [a, b]

    def decode(self, ids, leaf=LEAF):
        """Bytes of ids, concatenated up the same kind of tree."""
        if len(ids) <= leaf:
            return self.encoding.decode_bytes(ids)
        middle = len(ids) // 2
        return self.decode(ids[:middle], leaf) + self.decode(ids[middle:], leaf)


def tokenizer_file(name):
    """Path and word pattern of a tokenizer of the installed collection."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def codec(name=TOKENIZER, path=None, pattern=None):
    """The codec of a rank file, built once in each Python worker."""
    if path is None:
        path, own = tokenizer_file(name)
        pattern = pattern or own
    return kept(f"bpe {path} {pattern}", lambda: Codec(path, pattern))


def encode_texts(
    documents, text_col="text", name=TOKENIZER, path=None, pattern=None, leaf=LEAF, ids_col="ids"
):
    """The documents with their ids (array of int) in place of the texts.

    A null text is encoded as an empty one: no ids. Other columns stay as they are, but
    for one that has the name of ``ids_col`` already: the ids replace it.
    """
    fields = [f for f in documents.schema.fields if f.name not in (text_col, ids_col)]
    schema = T.StructType(
        [*fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()), False)]
    )
    source = documents.select(*[column(f.name) for f in fields], column(text_col))

    def run(batches):
        bpe = codec(name, path, pattern)
        for batch in batches:
            ids = [
                np.array(bpe.encode(text.as_py() or "", leaf), dtype=np.int32)
                for text in batch.column(len(fields))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(fields)], _lists(ids)], names=schema.fieldNames()
            )

    return source.mapInArrow(run, schema)


def _lists(parts):
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int32()))


def decode_ids(
    encoded, ids_col="ids", name=TOKENIZER, path=None, pattern=None, leaf=LEAF, text_col="text"
):
    """Encoded documents with their texts again. Null ids give an empty text."""
    fields = [f for f in encoded.schema.fields if f.name not in (ids_col, text_col)]
    schema = T.StructType([*fields, T.StructField(text_col, T.StringType(), False)])
    source = encoded.select(*[column(f.name) for f in fields], column(ids_col))

    def run(batches):
        bpe = codec(name, path, pattern)
        for batch in batches:
            texts = [bpe.decode(i.as_py() or [], leaf).decode() for i in batch.column(len(fields))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(fields)], pa.array(texts, type=pa.string())],
                names=schema.fieldNames(),
            )

    return source.mapInArrow(run, schema)


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(
    documents, id_col="doc_id", text_col="text", name=TOKENIZER, path=None, pattern=None, leaf=LEAF
):
    """Per document: number and digest of its ids, digest of the bytes decoded from them.

    Ids are digested as little-endian unsigned 32-bit numbers. A null text counts as an
    empty one. Every row, repeated or without an id, gives one row.
    """
    source = documents.select(column(id_col).alias("id"), column(text_col).alias("text"))
    schema = T.StructType(
        [T.StructField("id", source.schema["id"].dataType), *T._parse_datatype_string(DIGEST)]
    )

    def run(batches):
        bpe = codec(name, path, pattern)
        for batch in batches:
            counts, hashes, decoded = [], [], []
            for text in batch.column("text"):
                ids = bpe.encode(text.as_py() or "", leaf)
                counts.append(len(ids))
                hashes.append(hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids, leaf)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts, type=pa.int64()),
                    pa.array(hashes, type=pa.string()),
                    pa.array(decoded, type=pa.string()),
                ],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
