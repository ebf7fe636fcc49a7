"""Quality rules, line first: judge each line, drop the failures, then reject texts that lost too much.

Three rules judge a line that has a word:

- punctuation: it fails if more than ``MARKS`` of its characters (blanks aside) are ASCII marks or symbols, or if it has at
  least three words and most of them end in ``!!`` or a like run of marks;
- navigation: it fails with three or more separators (``|``, ``>``, bullets) standing alone, one for each
  ``PER_SEPARATOR`` words or more; or if it has at most ``SHORT`` words, does not end like a sentence, and half of its words
  are words of menus;
- boilerplate: it fails if it is a licence, cookie, copyright or script notice by its opening or fixed phrase.

Lines without a word are never judged. A text is rejected if its base figures fail or its failed lines
hold more than ``MOST_LOST`` of the characters in words.

Defined results: NULL and texts without words have zero for every figure and are rejected (too few
words); repeated rows are judged alike and all returned; an empty table gives no rows; extra columns
are kept by ``clean`` unless they have the name of a column that it adds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import as_bytes, slices, without

MIN_WORDS = 50
MOST_REPEATED = 50  # percent of the words
MARKS = 0.25
PER_SEPARATOR = 3
SHORT = 10
MOST_LOST = 0.5

SYMBOLS = b"#*$%&|<>"
SEPARATORS = frozenset([b"|", b"||", b">", b">>", b"/", b"\xc2\xbb", b"\xe2\x80\xa2", b"\xc2\xb7", b"-"])
# Words of menus in English, German, French and Spanish.
MENU = frozenset(
    (
        "home about contact login logout register sign in up menu search sitemap next previous prev back top faq help blog news "
        "archive share follow subscribe privacy terms cart account shop "
        "startseite kontakt anmelden abmelden registrieren suche menü weiter zurück hilfe impressum datenschutz warenkorb konto teilen "
        "accueil connexion déconnexion inscription recherche suivant précédent aide panier compte partager contactez mentions légales "
        "inicio contacto registro buscar menú siguiente anterior ayuda carrito cuenta compartir seguir privacidad"
    ).encode().split()
)
# Openings and phrases of notices, lower case.
# A letter or digit of any script ends an opening, so lines that hold one are read as text.
_OPENINGS = (
    r"licensed under|released under|distributed under|all rights reserved|copyright\b|\(c\)|©|"
    r"(?:this (?:web)?site|we) uses? cookies|accept (?:all )?cookies|please enable javascript|enable javascript|"
    r"terms of (?:use|service)|privacy policy|subscribe to our newsletter|skip to (?:main )?content"
)
NOTICE = re.compile(rf"^\W*(?:{_OPENINGS})|all rights reserved\W*$|use of cookies|lorem ipsum")
_NOTICE_WORDS = re.compile(rf"{_OPENINGS}|use of cookies|lorem ipsum".replace(r"\b", "").encode())
_MARK = re.compile(rb"[!-/:-@\[-`{-~]")
_SHOUT = re.compile(rb"[!?#$%&*]{2,}$")
_SENTENCE_END = re.compile(rb"(?:[.!?:;]|\xe2\x80\xa6)[\"')\]]*$")


def line_fails(line: bytes, words: list[bytes]) -> str | None:
    """The rule that the line fails: ``punctuation``, ``navigation``, ``boilerplate`` or None."""
    letters = sum(map(len, words))
    if len(_MARK.findall(line)) > MARKS * letters:
        return "punctuation"
    if len(words) >= 3 and 2 * sum(1 for w in words if _SHOUT.search(w)) > len(words):
        return "punctuation"
    separators = sum(1 for w in words if w in SEPARATORS)
    if separators >= 3 and separators * PER_SEPARATOR >= len(words) - separators:
        return "navigation"
    low = line.lower()
    if len(words) <= SHORT and not _SENTENCE_END.search(line.rstrip()):
        if 2 * sum(1 for w in low.split() if w.strip(b",.:;") in MENU) >= len(words):
            return "navigation"
    if _NOTICE_WORDS.search(low) and NOTICE.search(low.decode("utf-8", "replace")):
        return "boilerplate"
    return None


def judge(text: bytes | None) -> tuple[int, int, int, int, int, bool, bool, int, int, bytes]:
    """Base figures, verdicts, characters lost in lines, number of lines lost, and the text without these lines."""
    text = text or b""
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    kept_lines, lost_chars, lost_lines, repeated_lines = [], 0, 0, 0
    for line in lines:
        words = line.split()
        if not words:
            kept_lines.append(line)
            continue
        if line in seen:
            repeated_lines += 1
        seen.add(line)
        if line_fails(line, words):
            lost_lines += 1
            lost_chars += len(b"".join(words).decode("utf-8", "replace"))
        else:
            kept_lines.append(line)
    words = text.split()
    n = len(words)
    word_chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    repeats = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeats > MOST_REPEATED * n
    kept = not failed and lost_chars <= MOST_LOST * word_chars
    return n, word_chars, symbols, repeated_lines, repeats, failed, kept, lost_chars, lost_lines, b"\n".join(kept_lines)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) > 1_000_000:  # keeps the product of three below 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + ids[2:]
    _, at, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[at] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


FIGURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "lost_chars long, lost_lines long, clean_text string"
)
NAMES = [f.split()[0] for f in FIGURES.split(", ")]
_KINDS = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2 + [pa.string()]


def clean(docs: DataFrame, text_col: str = "text", texts: bool = True) -> DataFrame:
    """The input's rows and columns, the figures, the verdict ``kept`` and the text of the lines that pass.

    Without ``texts`` neither the input's text nor the cleaned one is returned.
    """
    added, kinds = (NAMES, _KINDS) if texts else (NAMES[:-1], _KINDS[:-1])
    base = without(docs, *NAMES)
    names = base.columns
    passed = [c for c in names if texts or c != text_col]
    sent = base.select(*[as_bytes(c).alias(c) if c == text_col else F.col(f"`{c}`") for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=512):
            found = [judge(t) for t in part.column(text_col).to_pylist()]
            columns = [part.column(c).cast(pa.string()) if c == text_col else part.column(c) for c in passed]
            for k, kind in enumerate(kinds):
                columns.append(pa.array([f[k] for f in found], pa.binary() if kind == pa.string() else kind).cast(kind))
            yield pa.record_batch(columns, [*passed, *added])

    fields = [f"`{c}` {base.schema[c].dataType.simpleString()}" for c in passed]
    return sent.mapInArrow(run, ", ".join([*fields, *FIGURES.split(", ")[: len(added)]]))
