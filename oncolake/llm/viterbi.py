"""Token counts of a unigram vocabulary: Aho-Corasick matches and a count-only Viterbi search."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm.byte_bpe import WordCache
from oncolake.llm.shipping import ship_package, small_batches
from oncolake.llm.textbytes import pieces

#: Sign that stands for a space, and what an unknown character costs beyond the worst piece. Both are
#: fixed values of the tokenizer format.
SPACE, PENALTY = "▁", 10.0
#: Characters up to which a text is cut at once.
CHUNK = 1 << 18


class UnigramCounter:
    """Counts the pieces of the best segmentation.

    Tie rules of the tokenizer: pieces are tried by ascending start; a later one replaces an earlier
    one at the same end only if its score is greater, so of equal scores the longest piece stays.
    A character without a piece of its own may be unknown, at the worst score less the penalty, and
    then counts as its bytes, if the vocabulary has byte pieces, else as one piece for a run of them.
    Scores are added in double precision from the left.
    """

    def __init__(self, vocabulary: tuple[tuple[str, float], ...], bytes_known: bool):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - PENALTY
        self.bytes_known = bytes_known
        self.cache = WordCache(lambda part: self.best(part)[0])
        # Where no piece can cross, a text may be cut: before a space sign, if pieces have it only at
        # their front, and around characters that are in no longer piece. Cuts need whole scores, as
        # their sums do not depend on the order of addition.
        whole = all(float(s).is_integer() for _, s in vocabulary) and bytes_known
        front = all(SPACE not in piece.lstrip(SPACE) for piece, _ in vocabulary)
        alone = "".join(c for c in "\n\t\r|" if not any(c in p and len(p) > 1 for p, _ in vocabulary))
        stop = re.escape(SPACE + alone)
        cut = f"{SPACE}*[^{stop}]+|{SPACE}+" + (f"|[{re.escape(alone)}]" if alone else "")
        self.parts = re.compile(cut if whole and front else r"(?s).+")

    def best(self, text: str) -> tuple[int, float]:
        """Number of pieces and score of the best segmentation of a text without cuts."""
        size = len(text)
        score, count, unknown = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        matches = self.automaton.iter(text)
        last, found = next(matches, (size, None))
        for end in range(1, size + 1):
            top, pieces_, single = None, 0, False
            while last == end - 1:  # the longest match comes first: ascending starts
                length, value = found
                begin = end - length
                value += score[begin]
                if top is None or value > top:
                    top, pieces_ = value, count[begin] + 1
                single |= length == 1
                last, found = next(matches, (size, None))
            if not single and (top is None or score[end - 1] + self.unknown > top):
                top, unknown[end] = score[end - 1] + self.unknown, True
                if self.bytes_known:
                    pieces_ = count[end - 1] + len(text[end - 1].encode("utf-8"))
                else:
                    pieces_ = count[end - 1] + (not unknown[end - 1])
            score[end], count[end] = top, pieces_
        return count[size], score[size]

    def count(self, text: str) -> int:
        """Number of pieces of a text as the tokenizer sees it: a space sign in front."""
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if len(text) <= CHUNK:
            return sum(map(self.cache.__getitem__, self.parts.findall(text)))
        return sum(self.cache[match.group()] for match in self.parts.finditer(text))


@functools.lru_cache(maxsize=2)
def _counter(vocabulary: tuple[tuple[str, float], ...], bytes_known: bool) -> UnigramCounter:
    return UnigramCounter(vocabulary, bytes_known)


def count_tokens(
    documents: DataFrame, vocabulary: tuple[tuple[str, float], ...], bytes_known: bool, text: str = "text"
) -> DataFrame:
    """Adds ``n_tokens``, the number of pieces of the best segmentation of every whole text.

    One narrow pass. Null and empty texts have no tokens. Other columns pass through; an existing
    column ``n_tokens`` is replaced. The vocabulary has a fixed size and goes to the workers with
    the function.
    """
    kept = [c for c in documents.columns if c != "n_tokens"]
    rows = documents.select(*kept)
    schema = rows.select("*", F.lit(0).cast("long").alias("n_tokens")).schema
    ship_package(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary, bytes_known)
        for batch in batches:
            for piece in pieces(batch, text, 8 << 20):
                values = piece.column(piece.schema.get_field_index(text))
                found = pa.array([counter.count(value.as_py() or "") for value in values], pa.int64())
                yield pa.RecordBatch.from_arrays([*piece.columns, found], names=[*kept, "n_tokens"])

    return rows.mapInArrow(count, schema)


def piece_vocabulary(model_file: str) -> tuple[tuple[tuple[str, float], ...], bool]:
    """Pieces with scores of a public model file, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    vocabulary = tuple((model.id_to_piece(i), float(model.get_score(i))) for i in plain)
    return vocabulary, sum(model.is_byte(i) for i in ids) == 256


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of pieces by the scores of the public 32k piece vocabulary."""
    import public_tokenizers

    small_batches(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    known = piece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return count_tokens(documents, *known).select("doc_id", "n_tokens")
