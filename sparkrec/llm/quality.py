"""Quality rules, line first: lines that fail a rule are removed, then documents
that lose too much of their text are rejected.

Every line with a word is held against rules on punctuation, navigation and
boilerplate (`line_fault`). The text is cleaned by dropping failing lines; a
document is rejected if it fails the base rules (too short, too many repeated
five-word windows) or if the dropped lines held more than `max_loss` of its
word characters.

A text is judged on its own, so the work is one pass of Arrow batches where the
rows are read: no shuffle, and no group that could be hot.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sparkrec.llm.common import pick, rewrite_texts

#: Fixed values of the base figures.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
WINDOW = 5

#: Phrases of page furniture in the languages of the corpus (English, German, French, Spanish); a line of at most
#: BOILERPLATE_WORDS words that holds one is dropped.
BOILERPLATE = (
    "all rights reserved", "click here", "cookie policy", "enable javascript", "lorem ipsum", "privacy policy",
    "read more", "sign in", "sign up", "skip to content", "subscribe to our", "terms of service", "terms of use",
    "alle rechte vorbehalten", "cookie-richtlinie", "datenschutzerklärung", "hier klicken", "impressum", "jetzt anmelden",
    "javascript aktivieren", "mehr erfahren", "newsletter abonnieren", "nutzungsbedingungen", "weiterlesen", "zum inhalt springen",
    "abonnez-vous", "activer javascript", "aller au contenu", "cliquez ici", "conditions générales", "inscrivez-vous",
    "lire la suite", "mentions légales", "politique de confidentialité", "politique de cookies", "se connecter", "tous droits réservés",
    "activar javascript", "aviso legal", "haga clic aquí", "iniciar sesión", "leer más", "política de cookies",
    "política de privacidad", "regístrate", "saltar al contenido", "suscríbete", "términos de uso", "todos los derechos reservados",
)
BOILERPLATE_WORDS = 12
ASCII_ALNUM = (string.ascii_letters + string.digits).encode()

PHRASES = ahocorasick.Automaton()
for _phrase in BOILERPLATE:
    PHRASES.add_word(_phrase, _phrase)
PHRASES.make_automaton()

SCHEMA = ("doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "kept boolean, n_bad_lines long, lost_chars long, clean_text string")


def line_fault(line: str, words: list[bytes]) -> str | None:
    """The rule that a line with words fails, or None.

    * navigation: link bars; at least 3 words that are only ``|``, ``>`` or
      ``»`` (2 on a line of at most BOILERPLATE_WORDS words), and one in four
      words of the line
    * punctuation: at least 3 words and as many marks of ``#*$%&<>`` as words,
      or a shouted ``!!`` on half of the words, or fewer letters and digits
      than half of the visible characters
    * repetition: at least 12 words, and each distinct word four times on average
    * boilerplate: a short line that holds a phrase of page furniture
    """
    n = len(words)
    if n >= 3:
        if "|" in line or ">" in line or "»" in line:
            bars = sum(w in (b"|", b">", b"\xc2\xbb") for w in words)
            if bars >= (2 if n <= BOILERPLATE_WORDS else 3) and 4 * bars >= n:
                return "navigation"
        if sum(map(line.count, "#*$%&<>")) >= n or 2 * line.count("!!") >= n:
            return "punctuation"
        solid = b"".join(words)
        plain = len(solid) - len(solid.translate(None, ASCII_ALNUM))  # most lines need no look at single characters
        if 2 * plain < len(solid) and 2 * sum(map(str.isalnum, line)) < len(solid.decode()):
            return "punctuation"
    if n >= 12 and 4 * len(set(words)) <= n:
        return "repetition"
    if n <= BOILERPLATE_WORDS:
        if next(PHRASES.iter(line.lower()), None):
            return "boilerplate"
    return None


def count_repeat_words(words: list[bytes]) -> int:
    """Words inside a five-word window that occurs twice or more."""
    windows = list(zip(*(words[k:] for k in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    flags = bytearray(len(words))
    mark = b"\x01" * WINDOW
    for i, w in enumerate(windows):
        if times[w] > 1:
            flags[i:i + WINDOW] = mark
    return flags.count(1)


def judge(text: str, min_words: int, max_repeat: int, max_loss: float) -> tuple:
    """All result columns after the id for one text."""
    words = text.encode().split()  # bytes split at exactly the six ASCII spaces
    word_chars = len(text) - sum(map(text.count, SPACES))
    repeat = count_repeat_words(words)
    seen, kept_lines, dups, bad, lost = set(), [], 0, 0, 0
    for line in text.split("\n"):
        own = line.encode().split()
        if own:
            if line in seen:
                dups += 1
            seen.add(line)
            if line_fault(line, own):
                bad += 1
                lost += len(line) - sum(map(line.count, SPACES))
                continue
        kept_lines.append(line)
    base_failed = len(words) < min_words or 100 * repeat > max_repeat * len(words)
    kept = not base_failed and lost <= max_loss * word_chars
    return (len(words), word_chars, sum(map(text.count, SYMBOLS)), dups, repeat, base_failed, kept, bad, lost,
            text if not bad else "\n".join(kept_lines))


def quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10,
            max_repeat: int = 20, max_loss: float = 0.3) -> DataFrame:
    """One row per input row: the base figures, ``kept``, and the cleaned text.

    Null texts count as empty; an empty text has no words and fails the base
    rules. `max_repeat` is in per cent of the words, `max_loss` a share of the
    word characters. Ids may be null or repeated; further columns of `docs`
    are not read.
    """
    texts = pick(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    names = [f.name for f in T.StructType.fromDDL(SCHEMA.format(id=id_type)).fields]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2 + [pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                rows = [judge(t.as_py(), min_words, max_repeat, max_loss) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names)

    return texts.mapInArrow(run, SCHEMA.format(id=id_type))


def clean(docs: DataFrame, *, text_col: str = "text", min_words: int = 10, max_repeat: int = 20, max_loss: float = 0.3) -> DataFrame:
    """`docs` without rejected rows, texts cleaned and ``n_chars`` renewed; all columns stay."""

    def verdict(text: str) -> str | None:
        out = judge(text, min_words, max_repeat, max_loss)
        return out[9] if out[6] else None

    return rewrite_texts(docs, verdict, text_col)
