"""Quality rules (line-first cleaning).

Every line is judged by punctuation, navigation and boilerplate rules; failing
lines are removed, and a document that loses too much of its text is rejected.

Defined results: a null or empty text has no words and is rejected (too short);
repeated rows give equal results; columns other than ``doc_id`` and ``text``
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm import textbatch as TB
from propensity.llm.common import doc_text, map_arrow, with_columns_of

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_LOST_SHARE = 0.5
SHORT_LINE_WORDS = 6
MIN_SEPARATORS = 3
MAX_SYMBOL_SHARE = 0.10
MIN_SHOUT_WORDS = 5
MAX_UPPER_SHARE = 0.8

#: Marks that end a sentence (last byte of their UTF-8 form), item separators, stock phrases (English, German, French, Spanish).
TERMINAL = TB.byte_set(b".!?\"':;)]") | TB.byte_set("…。！？”’»".encode())
BOILERPLATE = (
    "lorem ipsum", "enable javascript", "javascript is disabled", "use of cookies", "uses cookies",
    "accept cookies", "cookie policy", "privacy policy", "terms of use", "terms of service",
    "all rights reserved", "click here", "read more", "sign up for", "subscribe to our", "share this",
    "skip to content", "back to top", "follow us on", "powered by",
    "javascript aktivieren", "verwendet cookies", "verwenden cookies", "cookies akzeptieren", "cookie-richtlinie",
    "datenschutzerklärung", "nutzungsbedingungen", "alle rechte vorbehalten", "hier klicken", "newsletter abonnieren",
    "zum inhalt springen", "nach oben scrollen", "folgen sie uns",
    "activer javascript", "activez javascript", "utilise des cookies", "utilisons des cookies", "accepter les cookies",
    "politique de confidentialité", "conditions d'utilisation", "tous droits réservés", "cliquez ici", "lire la suite",
    "abonnez-vous à", "aller au contenu", "haut de page", "suivez-nous sur",
    "activar javascript", "active javascript", "utiliza cookies", "utilizamos cookies", "aceptar cookies", "aceptar las cookies",
    "política de privacidad", "condiciones de uso", "todos los derechos reservados", "haga clic aquí", "haz clic aquí",
    "seguir leyendo", "suscríbete a", "ir al contenido", "volver arriba", "síguenos en",
)
_PHRASES = "(?i)" + "|".join(BOILERPLATE)
_UPPER = TB.byte_set(bytes(range(65, 91)))
_LETTER = _UPPER | TB.byte_set(bytes(range(97, 123)))
_BAR = TB.byte_set(b"|")

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_lines long, n_lines_removed long, words_removed long, base_failed boolean, kept boolean")


def line_verdicts(offsets: np.ndarray, data: np.ndarray, word_starts: np.ndarray):
    """Lines of a slice and the rule each one fails: 0 none, 1 punctuation, 2 navigation, 3 boilerplate."""
    starts, ends, doc = TB.lines(offsets, data)
    total = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    span = lambda sums: sums[ends] - sums[starts]
    n_words = np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts)
    inside = TB.IS_WORD[data]
    chars = span(total(inside & TB.IS_HEAD[data]))
    symbols = span(total(TB.IS_SYMBOL[data]))
    bars = span(total(_BAR[data]))
    letters, upper = span(total(_LETTER[data])), span(total(_UPPER[data]))
    seen = np.maximum.accumulate(np.where(inside, np.arange(len(data)), -1)) if len(data) else np.zeros(0, np.int64)
    last = np.where(ends > starts, seen[np.maximum(ends - 1, 0)] if len(data) else -1, -1)
    has = (n_words > 0) & (last >= starts)
    closing = np.zeros(len(starts), dtype=bool)
    closing[has] = TERMINAL[data[last[has]]]
    rule = np.zeros(len(starts), dtype=np.int8)
    at = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=at[1:])
    phrase = pc.match_substring_regex(TB.strings(at, data[data != 10], pa.large_string()), _PHRASES)
    rule[np.asarray(phrase) & has] = 3
    rule[has & (bars >= MIN_SEPARATORS) & (3 * bars >= n_words - bars)] = 2
    ragged = ~closing & (n_words < SHORT_LINE_WORDS)
    noisy = symbols > MAX_SYMBOL_SHARE * chars
    shout = (n_words >= MIN_SHOUT_WORDS) & (letters > 0) & (upper > MAX_UPPER_SHARE * letters)
    rule[has & (rule == 0) & (ragged | noisy | shout)] = 1
    return starts, ends, doc, n_words, rule


def base_counts(offsets: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    """The counts per document that need no judgement."""
    n = len(offsets) - 1
    starts, ends, n_words = TB.words(offsets, data)
    inside = TB.IS_WORD[data]
    word_doc = np.repeat(np.arange(n), n_words)
    code = TB.word_codes(starts, ends, data)
    ls, le, ld = TB.lines(offsets, data)
    with_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    line = TB.line_codes(ls, le, data)[with_word]
    line_doc = ld[with_word]
    first = np.unique(line_doc * (line.max() + 1 if len(line) else 1) + line, return_index=True)[1]
    dup = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[first], minlength=n)
    return {"n_words": n_words.astype(np.int64),
            "word_chars": TB.per_doc(inside & TB.IS_HEAD[data], offsets),
            "n_symbols": TB.per_doc(TB.IS_SYMBOL[data], offsets),
            "n_dup_lines": dup.astype(np.int64),
            "n_repeat_words": TB.repeated_window_words(word_doc, code, n),
            "_starts": starts, "_code": code, "_word_doc": word_doc, "_ends": ends}


def _judge(rows: Iterator[pa.RecordBatch], with_text: bool, extra: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for part in TB.slices(batch):
            offsets, data = TB.utf8(part.column("text"))
            n = part.num_rows
            base = base_counts(offsets, data)
            starts, ends, doc, n_words, rule = line_verdicts(offsets, data, base["_starts"])
            bad = rule > 0
            lost = np.bincount(doc[bad], weights=n_words[bad], minlength=n).astype(np.int64)
            failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])
            kept = ~failed & (lost <= MAX_LOST_SHARE * base["n_words"])
            out = {"doc_id": part.column("doc_id"),
                   **{k: pa.array(base[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                     "n_repeat_words")},
                   "n_lines": pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
                   "n_lines_removed": pa.array(np.bincount(doc[bad], minlength=n).astype(np.int64)),
                   "words_removed": pa.array(lost), "base_failed": pa.array(failed), "kept": pa.array(kept)}
            if with_text:
                out["text"] = _without(offsets, data, starts[bad], ends[bad])
                out |= {c: part.column(c) for c in extra}
            yield pa.RecordBatch.from_pydict(out)


def _without(offsets: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts without these lines and the line break that follows each (or comes before the last)."""
    edge = np.zeros(len(data) + 2, dtype=np.int64)
    doc_end = offsets[np.searchsorted(offsets, ends, side="left")] if len(ends) else ends
    last = ends == doc_end
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.where(last, ends, ends + 1), -1)
    keep = np.cumsum(edge[:len(data)]) == 0
    # a removed last line takes the break before it along, if that is still there
    doc_start = offsets[np.searchsorted(offsets, starts, side="right") - 1] if len(starts) else starts
    tail = starts[last & (starts > doc_start)] - 1
    keep[tail] = False
    at = np.concatenate([[0], np.cumsum(keep)])[offsets]
    return TB.strings(at, data[keep], pa.large_string()).cast(pa.string())


def line_rules(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document, one row per row of ``docs``."""
    return map_arrow(doc_text(docs), lambda rows: _judge(rows, False, []), SCHEMA)


def clean_lines(docs: DataFrame) -> DataFrame:
    """Kept documents with their failing lines removed; other columns stay as they are.

    ``n_chars``, if present, is the length of the cleaned text.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    alias = {c: f"_keep_{i}" for i, c in enumerate(rest)}
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
                        *[F.col(f"`{c}`").alias(a) for c, a in alias.items()])
    kinds = {f.name: f.dataType.simpleString() for f in given.schema.fields}
    schema = SCHEMA + ", text string" + "".join(f", {a} {kinds[a]}" for a in alias.values())
    names = list(alias.values())
    judged = map_arrow(given, lambda rows: _judge(rows, True, names), schema).where("kept")
    back = judged.select(*[F.col(alias[c]).alias(c) if c in alias else F.col(c) for c in docs.columns])
    return with_columns_of(back, F.col("text"))
