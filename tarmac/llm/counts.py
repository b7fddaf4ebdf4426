"""Token counts of a unigram vocabulary by dynamic programming shared in a trie.

A text's pre-tokens are its words ``[^\\x20\\x09-\\x0D]+``, each behind a word mark.
A word's tokens are the best-scoring segmentation into vocabulary pieces (highest
sum of scores, then fewest tokens); a character no piece covers costs one token
per UTF-8 byte. The best score and count of a prefix do not depend on what
follows, so distinct pre-tokens go into a trie and each trie node - each distinct
prefix - is solved once; the count at a word's last node is stored and looked up
for every further occurrence. A scan task takes its texts in slices; a slice's new
words form one trie, and when ``MAX_WORDS`` counts are stored they are forgotten,
which bounds memory and changes no result.

Scores: a vocabulary piece of rank r has the log-probability of a Zipf law,
``-log(r + 2.7)`` minus a constant; the file is a parameter.

Edge cases: a null or empty text, or one without words, has 0 words and 0
tokens; repeated rows are counted each; an empty table gives an empty result;
columns other than id and text are ignored."""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
#: texts whose new words form one trie, and words whose counts a task remembers
SLICE_ROWS, MAX_WORDS = 2_000, 1_000_000
_cached: dict = {}


def vocabulary(path: str | None = None) -> dict[str, float]:
    """Piece -> score of a sentencepiece file; control and byte pieces left out."""
    if path not in _cached:
        import public_tokenizers
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
        n = sp.get_piece_size()
        norm = math.log(sum(1 / (r + 2.7) for r in range(n)))
        _cached[path] = {sp.id_to_piece(i): -math.log(i + 2.7) - norm for i in range(n)
                         if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
    return _cached[path]


class Trie:
    """Depth-first walk of the trie of distinct pre-tokens.

    Sorted words are the leaves of their trie from left to right: a word shares the
    path of its longest common prefix with the word before it, and the rest of it are
    new nodes. Each node holds the best segmentation of its prefix; nodes off the
    current path are never visited again and are dropped, terminal counts stay."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.byte_score = min(pieces.values(), default=0.0) - 10.0
        self.nodes = 0  # solved so far
        ends: dict[str, set[int]] = {}
        for p in pieces:
            if len(p) > 2:
                ends.setdefault(p[-3:], set()).add(len(p))
        self.ends = {k: (1, 2, *sorted(v)) for k, v in ends.items()}  # lengths of the pieces with these last letters

    def solve(self, words: list[str]) -> list[tuple[int, int]]:
        """(tokens, of them bytes) of each of the sorted words."""
        piece, ends, low = self.pieces.get, self.ends.get, self.byte_score
        score, tokens, spelled = [0.0], [0], [0]  # of the prefixes on the path
        before, out = "", []
        for word in words:
            n = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                n += 1
            del score[n + 1:], tokens[n + 1:], spelled[n + 1:]
            self.nodes += len(word) - n
            for end in range(n + 1, len(word) + 1):
                ch = word[end - 1]
                width = 1 if ch < "\x80" else len(ch.encode("utf-8", "surrogatepass"))
                s, t, b = score[-1] + width * low, tokens[-1] + width, spelled[-1] + width
                for size in ends(word[end - 3:end], (1, 2)) if end > 2 else range(1, end + 1):
                    if size > end:
                        break
                    v = piece(word[end - size:end])
                    if v is not None:
                        v += score[end - size]
                        if v > s or v == s and (tokens[end - size] + 1, spelled[end - size]) < (t, b):
                            s, t, b = v, tokens[end - size] + 1, spelled[end - size]
                score.append(s)
                tokens.append(t)
                spelled.append(b)
            out.append((tokens[-1], spelled[-1]))
            before = word
        return out


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``id_col, n_words, n_tokens, n_byte_tokens`` of every row; no shuffle."""

    def work(batches):
        trie, known = Trie(vocabulary(path)), {}
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(lo, SLICE_ROWS)
                texts = [Counter((raw.as_py() or b"").split()) for raw in b.column(1)]
                if len(known) > MAX_WORDS:
                    known.clear()
                new = sorted(set().union(*texts) - known.keys())
                # a word's text and its UTF-8 bytes sort alike
                known.update(zip(new, trie.solve([MARK + w.decode("utf-8", "replace") for w in new])))
                out: list[tuple] = []
                for i, words in zip(b.column(0).to_pylist(), texts):
                    n = tokens = spelled = 0
                    for w, c in words.items():
                        t, s = known[w]
                        n += c
                        tokens += c * t
                        spelled += c * s
                    out.append((i, n, tokens, spelled))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                 ["id", "n_words", "n_tokens", "n_byte_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    return rows.mapInArrow(work, "id long, n_words long, n_tokens long, n_byte_tokens long").withColumnRenamed("id", id_col)
