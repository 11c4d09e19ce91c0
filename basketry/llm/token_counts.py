"""Number of unigram pieces of a text, without the pieces: count-only Viterbi.

Matches of the vocabulary come from an Aho-Corasick automaton, by their end. Dynamic programming
keeps, per place in the text, only the best score and the number of pieces that gives it.
Ties and unknown characters follow the unigram tokenizer of the `tokenizers` library: of equal
scores the path whose last piece starts first wins; a character that is no piece itself scores
UNKNOWN_PENALTY below the lowest piece, and neighbouring unknown characters are one piece.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import ship

ship(__name__)

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
# words whose counts a task remembers at a time
REMEMBERED = 500_000


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file: the normal ones, no control or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class Counter:
    """Counts pieces of texts under one vocabulary."""

    def __init__(self, vocabulary: Sequence[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), float(score)))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.unknown = min((float(s) for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        # a space within or at the end of a piece ties words together; at the start it does not
        self.by_word = SPACE in self.single and not any(
            SPACE in p.lstrip(SPACE) for p, _ in vocabulary)
        self.known: dict[str, tuple[int, float]] = {}

    def path(self, text: str) -> tuple[int, float]:
        """Pieces and score of the best path through `text`."""
        n = len(text)
        score: list[float | None] = [None] * (n + 1)
        count, unknown_last = [0] * (n + 1), [False] * (n + 1)
        score[0] = 0.0
        matches = self.automaton.iter(text) if len(self.automaton) else iter(())
        found = next(matches, None)
        single, unknown = self.single, self.unknown
        for end in range(1, n + 1):
            best, pieces = None, 0
            is_unknown = False
            while found is not None and found[0] == end - 1:
                size, value = found[1]
                start = end - size
                if score[start] is not None:
                    total = score[start] + value
                    # longest first, and only a better one replaces it
                    if best is None or total > best or (total == best and size > longest):
                        best, pieces, longest = total, count[start] + 1, size
                found = next(matches, None)
            if text[end - 1] not in single and score[end - 1] is not None:
                total = score[end - 1] + unknown
                if best is None or total > best:
                    best, is_unknown = total, True
                    pieces = count[end - 1] + (not unknown_last[end - 1])
            score[end], count[end], unknown_last[end] = best, pieces, is_unknown
        return count[n], score[n]

    def text(self, text: str) -> tuple[int, float]:
        """Pieces and score of a text, whose spaces are SPACE and which gets one in front.

        If no piece crosses the start of a word, words are independent and looked up.
        """
        if not text:
            return 0, 0.0
        marked = SPACE + text.replace(" ", SPACE)
        if not self.by_word:
            return self.path(marked)
        pieces, score = 0, 0.0
        known = self.known
        for word in _words(marked):
            found = known.get(word)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = known[word] = self.path(word)
            pieces += found[0]
            score += found[1]
        return pieces, score


def _words(marked: str) -> list[str]:
    """Cuts before each run of SPACE; the text starts with one."""
    out, run = [], ""
    for part in marked.split(SPACE)[1:]:
        if part:
            out.append(run + SPACE + part)
            run = ""
        else:
            run += SPACE
    if run:
        out.append(run)
    return out


def count_tokens(docs: DataFrame, vocabulary: Sequence[tuple[str, float]]) -> DataFrame:
    """doc_id, n_tokens, score of every text.

    NULL and empty texts have 0 tokens and score 0. Texts of any length are counted whole; memory
    is one number per character. Scores are added word by word, so they are exact for whole
    numbers. Repeated rows and NULL ids each get their row; no rows give no rows. Columns other
    than doc_id and text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(list(vocabulary))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches):
        counter = Counter(shared.value)
        for batch in batches:
            found = [counter.text(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c for c, _ in found], pa.int64()),
                 pa.array([s for _, s in found], pa.float64())], ["doc_id", "n_tokens", "score"])

    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n_tokens bigint, score double")
