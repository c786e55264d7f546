"""Column functions over prompts, transcripts and replies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The characters Python's str.strip and str.split treat as blank, as a
# pattern (Unicode white space and four separators) and as a list.
WS = r"(?U)[\s\x1c-\x1f]"
_BLANK_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029),
    (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
BLANKS = "".join(chr(c) for low, high in _BLANK_RANGES for c in range(low, high + 1))

# Transcript markers, default texts and reply-check lists.
TURN_MARKER = "H:"
LONG_TURN_MARKER = "Human:"
REPLY_MARKER = "Assistant:"
DEFAULT_PROMPT = "Continue the conversation:"
REPEATABLE_CHARS = ["…", ".", ")", "]", "}", "~", "*", "+", "-", "_"]
NONSENSE_WORDS = ["Calculator", "stairs", "campus", "Generator"]
FALLBACK_REPLIES = [
    "I'd be happy to help with that question.",
    "That's an interesting topic. Let me provide some helpful information.",
    "I can help you with that. Here's what I know:",
    "That's a good question. Let me explain:",
    "I understand what you're asking about.",
]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Remove Unicode blanks at both ends (``F.trim`` only removes spaces)."""
    return F.btrim(_c(col), F.lit(BLANKS))


def clean_text(col: Column | str) -> Column:
    """Strip, straighten curly quotes, collapse runs of blanks to one space."""
    straight = strip(col)
    for curly, plain in (("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'")):
        straight = F.replace(straight, F.lit(curly), F.lit(plain))
    return F.regexp_replace(straight, f"{WS}+", " ")


def words(col: Column | str) -> Column:
    """Blank-separated words, without empty ones.

    A stripped text has no blank ends, so only the empty text needs care.
    """
    return F.array_remove(F.split(strip(col), f"{WS}+"), "")


def n_words(col: Column | str) -> Column:
    return F.size(words(col))


def count_of(col: Column | str, needle: str) -> Column:
    """Non-overlapping occurrences of a fixed string."""
    col = _c(col)
    removed = F.length(col) - F.length(F.replace(col, F.lit(needle), F.lit("")))
    return (removed / F.lit(len(needle))).cast("long")


def compose(prompt: Column | str, response: Column | str, sep: str = " ") -> Column:
    return F.concat(_c(prompt), F.lit(sep), _c(response))


def default_text(col: Column | str) -> Column:
    return F.coalesce(_c(col), F.lit(""))


def default_metric(col: Column | str, value: float = 0.0) -> Column:
    return F.coalesce(_c(col), F.lit(float(value)))


def is_blank(col: Column | str) -> Column:
    return strip(col) == ""


def preview(col: Column | str, size: int) -> Column:
    col = _c(col)
    return F.when(F.length(col) > size, F.concat(F.substring(col, 1, size), F.lit("..."))).otherwise(col)


# --- transcripts -----------------------------------------------------------

def _turn_bounds(text: Column, marker: str) -> tuple[Column, Column]:
    start = F.instr(text, marker)
    newline = F.position(F.lit("\n"), text, start)
    return start, F.when(newline > 0, newline).otherwise(F.length(text) + 1)


def first_turn(transcript: Column, marker: str = TURN_MARKER, default: str = DEFAULT_PROMPT) -> Column:
    """The first marked line of a transcript, or ``default`` if there is none."""
    start, end = _turn_bounds(transcript, marker)
    body = F.substring(transcript, start + len(marker), end - start - len(marker))
    return F.when(start > 0, strip(body)).otherwise(F.lit(default))


def after_first_turn(transcript: Column, marker: str = TURN_MARKER) -> Column:
    """All that follows the first marked line; the whole text if there is none."""
    start, end = _turn_bounds(transcript, marker)
    rest = F.substring(transcript, end, F.length(transcript))
    return F.when(start > 0, strip(rest)).otherwise(transcript)


# --- replies ---------------------------------------------------------------

def generation_prompt(prompt: Column | str) -> Column:
    prompt = _c(prompt)
    wrapped = F.concat(F.lit(f"{LONG_TURN_MARKER} "), prompt, F.lit(f"\n\n{REPLY_MARKER}"))
    return F.when(F.startswith(prompt, F.lit(LONG_TURN_MARKER)), prompt).otherwise(wrapped)


def without_prompt(reply: Column | str, prompt: Column | str) -> Column:
    reply, prompt = _c(reply), _c(prompt)
    rest = F.substring(reply, F.length(prompt) + 1, F.length(reply))
    return strip(F.when(F.startswith(reply, prompt), rest).otherwise(reply))


def without_leading_turn(reply: Column | str) -> Column:
    """A reply that opens with a human turn keeps what follows the assistant marker."""
    reply = _c(reply)
    at = F.instr(reply, REPLY_MARKER)
    rest = strip(F.substring(reply, at + len(REPLY_MARKER), F.length(reply)))
    opened = F.startswith(reply, F.lit(LONG_TURN_MARKER))
    return F.when(opened & (at > 0), rest).when(opened, F.lit("")).otherwise(reply)


def joined_lines(reply: Column | str) -> Column:
    """Lines up to the next human turn, without blank and assistant lines, on one line."""
    lines = F.transform(F.split(_c(reply), "\n"), strip)
    is_turn = F.transform(lines, lambda x: F.startswith(x, F.lit(LONG_TURN_MARKER)))
    stop = F.array_position(is_turn, True)
    head = F.slice(lines, F.lit(1), F.when(stop > 0, stop - 1).otherwise(F.size(lines)).cast("int"))
    kept = F.filter(head, lambda x: (x != "") & ~F.startswith(x, F.lit(REPLY_MARKER)))
    return strip(F.array_join(kept, " "))


def clean_reply(reply: Column | str, prompt: Column | str) -> Column:
    return joined_lines(without_leading_turn(without_prompt(reply, prompt)))


def has_dominant_word(col: Column | str, share: float = 0.3, over: int = 5) -> Column:
    """Some word makes up more than ``share`` of a text of more than ``over`` words.

    In the sorted word list such a word covers at least one of the positions
    1, 1+s, 1+2s, ... with s = floor(share * n), so only those few words are
    counted: one sort per text, with no all-against-all comparison.
    """
    ordered = F.array_sort(words(col))

    def check(w: Column) -> Column:
        n = F.size(w)
        stride = F.greatest(F.floor(n * F.lit(share)).cast("int"), F.lit(1))
        picks = F.array_distinct(F.transform(F.sequence(F.lit(1), n, stride), lambda i: F.element_at(w, i)))
        return F.exists(picks, lambda p: F.size(F.filter(w, lambda x: x == p)) > n * F.lit(share))

    # One-element transform: the sorted list is computed once per row.
    flags = F.transform(F.array(ordered), lambda w: F.when(F.size(w) > over, check(w)).otherwise(F.lit(False)))
    return F.element_at(flags, 1)


def is_broken(col: Column | str) -> Column:
    """Signs of a generation breakdown: too short, or too repetitive."""
    col = _c(col)
    checks = [F.length(col) < 5]
    checks += [count_of(col, ch) > 20 for ch in REPEATABLE_CHARS]
    checks += [count_of(col, word) > 5 for word in NONSENSE_WORDS]
    checks.append(has_dominant_word(col))
    return reduce(lambda a, b: a | b, checks)


def is_corrupt(col: Column | str) -> Column:
    """Shorter than five characters, or fewer than five different ones."""
    col = _c(col)
    return (F.length(col) < 5) | (F.size(F.array_distinct(F.split(col, ""))) < 5)


def with_fallback(reply: Column | str, broken: Column, pick: Column) -> Column:
    """Replace a broken reply by a fixed one, chosen by an integer column."""
    options = F.array(*[F.lit(x) for x in FALLBACK_REPLIES])
    chosen = F.element_at(options, (F.pmod(pick, F.lit(len(FALLBACK_REPLIES))) + 1).cast("int"))
    return F.when(broken, chosen).otherwise(_c(reply))
