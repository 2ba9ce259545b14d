"""Terms of a text: maximal runs of ASCII letters, ASCII digits and non-ASCII characters, only A-Z lower-cased."""

from __future__ import annotations

#: Every byte to itself, A-Z to a-z, and all other ASCII but digits and letters to a space; bytes above 127 belong to
#: non-ASCII characters and are part of terms.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)

#: The same terms as a regular expression of Java and of DuckDB, on text that is lower-cased from A to Z.
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms_of(text: str) -> list[bytes]:
    """The terms in order, as UTF-8; none of an empty text."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()
