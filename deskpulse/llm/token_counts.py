"""Token counts of whole texts, without keeping the tokens."""

import re

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskpulse.llm.bpe_tree import tokenizer_file
from deskpulse.llm.common import column, kept

TOKENIZER = "word_bpe_49k.json"
MAX_TOKENS = 2048
# A batch for the tokenizer has about so many bytes.
BATCH_BYTES = 1 << 20
# Longer texts are cut into parts of about so many bytes.
PART_BYTES = 1 << 16
# Counts of words a Python worker remembers before it starts anew.
REMEMBERED = 1 << 18
# White space, which the tokenizer drops and no token or special string holds.
SAFE = re.compile(rb"[\x20\x09-\x0D]")


def parts_of(text, size=PART_BYTES):
    """The bytes of a text in parts of about ``size`` bytes, cut at white space only."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


class Counter:
    """Counts tokens by words: white space is a safe boundary everywhere."""

    def __init__(self, path):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = {}

    def learn(self, words):
        """Counts of words not seen before, in batches balanced by bytes."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = [w for w in words if w not in self.known]
        batch, size = [], 0
        for word in new:
            batch.append(word)
            size += len(word)
            if size >= BATCH_BYTES:
                self._learn(batch)
                batch, size = [], 0
        if batch:
            self._learn(batch)

    def _learn(self, batch):
        encoded = self.tokenizer.encode_batch_fast(
            [w.decode() for w in batch], add_special_tokens=False
        )
        for word, found in zip(batch, encoded):
            self.known[word] = len(found)

    def counts(self, texts):
        """Number of tokens of each text; a batch takes about BATCH_BYTES of text."""
        totals = [0] * len(texts)
        held, size = [], 0
        for at, text in enumerate(texts):
            for part in parts_of((text or "").encode()):
                held.append((at, part))
                size += len(part)
                if size >= BATCH_BYTES:
                    self._count(held, totals)
                    held, size = [], 0
        self._count(held, totals)
        return totals

    def _count(self, held, totals):
        words = [(at, part.split()) for at, part in held]
        self.learn({w for _, ws in words for w in ws})
        known = self.known
        for at, ws in words:
            totals[at] += sum(map(known.__getitem__, ws))


def token_counts(
    documents, id_col="doc_id", text_col="text", name=TOKENIZER, path=None, max_tokens=MAX_TOKENS
):
    """Per document: ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    The tokenizer must drop white space before it splits, as the default one does; then
    texts may be cut there without a change. Added special tokens inside a text are
    recognised as the tokenizer does by default. A null text counts as an empty one.
    Every row, repeated or without an id, gives one row.
    """
    source = documents.select(column(id_col).alias("id"), column(text_col).alias("text"))

    def run(batches):
        file = path or tokenizer_file(name)[0]
        counter = kept(f"counter {file}", lambda: Counter(file))
        for batch in batches:
            counts = counter.counts(batch.column("text").to_pylist())
            lengths = pa.compute.binary_length(batch.column("text")).fill_null(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), lengths.cast(pa.int64()), pa.array(counts, type=pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    schema = T.StructType(
        [
            T.StructField("id", source.schema["id"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    counted = source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
    return counted.withColumn("over_limit", F.col("n_tokens") > max_tokens)
