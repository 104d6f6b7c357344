"""Token counts by a vocabulary of the tokenizers library.

Huge documents are encoded in overlapping chunks with offsets. In an overlap both
encodings see the same text; they are spliced at a boundary that is stable whatever
surrounds it: a blank after a character other than white space, where a token begins
in both. Where the overlap has none, it is widened, and at last the chunk.

Other documents are cut at all such boundaries, and equal pieces are encoded once.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from ferrylog.llm.bpe import Memo, stable_pieces, strings_of

#: Characters from which a document is huge, of a chunk, and of an overlap at first.
HUGE, CHUNK, OVERLAP = 1 << 15, 1 << 14, 256
_STABLE_BLANK = re.compile(r"(?<=\S) ")


class Chunked:
    """Counts a text's tokens chunk by chunk; ``encode`` gives the token starts of a string."""

    def __init__(self, encode, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.encode, self.chunk, self.overlap = encode, chunk, overlap
        self.widened = 0

    def _splice(self, text, start, end, left, nxt, right):
        """The middle one of the stable boundaries that both encodings have between ``nxt`` and ``end``."""
        found = []
        for m in _STABLE_BLANK.finditer(text, nxt, end):
            p = m.start()
            i, j = bisect_left(left, p - start), bisect_left(right, p - nxt)
            # A boundary at the first character of the right chunk proves nothing of what is before it.
            if p > nxt and i < len(left) and left[i] == p - start and j < len(right) and right[j] == p - nxt:
                found.append((p, i, j))
        return found[len(found) // 2] if found else None

    def count(self, text: str) -> int:
        total = start = skip = 0  # tokens of the current chunk before ``skip`` are counted already
        size = self.chunk
        end = min(len(text), size)
        left = self.encode(text[:end])
        while end < len(text):
            overlap = self.overlap
            while True:
                nxt = max(start, end - overlap)
                right_end = min(len(text), nxt + max(size, 2 * overlap))
                right = self.encode(text[nxt:right_end]) if nxt > start else None
                at = self._splice(text, start, end, left, nxt, right) if right is not None else None
                if at is not None and at[1] >= skip:
                    break
                self.widened += 1
                if right is None:  # the whole chunk has no boundary: a longer one
                    size *= 2
                    end = min(len(text), start + size)
                    left = self.encode(text[start:end])
                    overlap = self.overlap
                    if end == len(text):
                        return total + len(left) - skip
                else:
                    overlap *= 2
            total += at[1] - skip
            start, end, left, skip = nxt, right_end, right, at[2]
            size = self.chunk
        return total + len(left) - skip


_counters: dict = {}


def _counter(path: str):
    if path not in _counters:
        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()

        def many(pieces):
            return [len(e.ids) for e in library.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)]

        def starts(text):
            return [a for a, _ in library.encode(text, add_special_tokens=False).offsets]

        _counters[path] = library, Memo(many), starts
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", out: str = "n_tokens",
                 huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Add the number of tokens of whole texts, without added special tokens.

    Texts of ``huge`` characters or more are encoded in chunks of ``chunk`` that overlap
    by ``overlap`` at first; the counts are the same whatever these are.
    Special strings inside texts count as the library counts them by default. Null and
    empty texts have none. Repeated rows and other columns are kept; a column named
    like ``out`` is replaced.
    """
    docs = docs.drop(out)
    names = docs.schema.names
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])

    def run(batches):
        library, memo, starts = _counter(path)
        chunked = Chunked(starts, chunk, overlap)
        for batch in batches:
            numbers = []
            for _, _, texts in strings_of(batch, text_col):
                cut = [stable_pieces(t) if len(t) < huge else None for t in texts]
                known = memo.learn(chain.from_iterable(c[1:] for c in cut if c))
                heads = library.encode_batch_fast([c[0] if c else "" for c in cut], add_special_tokens=False)
                for text, pieces, head in zip(texts, cut, heads):
                    numbers.append(chunked.count(text) if pieces is None else
                                   len(head.ids) + sum(map(known.__getitem__, pieces[1:])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=[*names, out])

    return docs.mapInArrow(run, schema)


def token_report(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    done = count_tokens(docs.select("doc_id", "text"), path)
    return done.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
                       (F.col("n_tokens") > limit).alias("over_limit"))
