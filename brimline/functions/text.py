"""Text expressions: numbers as written on pages, accent-free names, header rules."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# A decimal number, or a spelled infinity; rules out what only Java reads as a double ("1d").
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"

BLANKS = " \t\n\r\x0b\x0c\u00a0"


def number(text: Column) -> Column:
    """Text as a double; what is not a number, and NaN, is NULL."""
    clean = F.btrim(text, F.lit(BLANKS))
    return F.when(clean.rlike(NUMBER), clean.try_cast("double"))


def tolerant_float(text: Column) -> Column:
    """As :func:`number`, with thousands commas allowed."""
    return number(F.replace(text, F.lit(","), F.lit("")))


def tolerant_int(text: Column) -> Column:
    """A tolerant number cut to an integer; infinities and overflow are NULL."""
    return tolerant_float(text).try_cast("int")


@cache
def _folding() -> tuple[str, str, dict[str, str]]:
    """What is kept of characters that decompose: one-to-one pairs for ``translate``, and
    the few that become several letters or digits.

    Derived from the Unicode tables; Hangul syllables follow a rule, see :func:`_jamo`.
    """
    source, folded, several = [], [], {}
    for code in range(0x80, 0x110000):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if c.isalnum() or c.isspace())
        if base == char or not base:
            continue  # unchanged, or dropped as neither letter, digit nor space
        if len(base) == 1:
            source.append(char)
            folded.append(base)
        else:
            several[char] = base
    return "".join(source), "".join(folded), several


def _jamo(letter: Column) -> Column:
    """The two or three parts of a Hangul syllable, which its number in the block spells."""
    n = F.ascii(letter) - 0xAC00
    char = lambda code: F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")
    last = F.when(n % 28 > 0, char(n % 28 + 0x11A7)).otherwise("")
    lead, vowel = F.floor(n / 588) + 0x1100, F.floor(n % 588 / 28) + 0x1161
    return F.concat(char(lead.cast("int")), char(vowel.cast("int")), last)


def normalize_text(text: Column) -> Column:
    """Lower-case letters, digits and spaces only, without accents (``d`` with a stroke is
    a letter of its own and stays)."""
    source, folded, several = _folding()
    text = F.coalesce(text, F.lit(""))
    # One literal each, folded once by the optimizer; looked up for non-ASCII letters only.
    table = F.str_to_map(F.lit("\u0002".join(f"{k}\u0001{v}" for k, v in several.items())), F.lit("\u0002"), F.lit("\u0001"))
    letter = lambda c: (
        F.when((c >= "\uac00") & (c <= "\ud7a3") & (F.length(c) == 1), _jamo(c))
        .when(c > "\u007f", F.coalesce(F.element_at(table, c), c)).otherwise(c)
    )
    spelled_out = F.array_join(F.transform(F.split(text, ""), letter), "")
    has_several = (F.length(F.translate(text, "".join(several), "")) < F.length(text)) | text.rlike("[\uac00-\ud7a3]")
    expanded = F.when(has_several, spelled_out).otherwise(text)
    plain = F.translate(expanded, source, folded)
    kept = F.regexp_replace(plain, r"(?U)[^\p{L}\p{N}\s]+", "")
    return F.regexp_replace(F.lower(kept), r"(?U)^\s+|\s+$", "")


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# Keyword rules from a normalised header to a record field, tried in order.
# A rule holds when every group of alternatives has a keyword in the header.
HEADER_RULES = [
    ("ten_ho", [["ten"]]),
    ("timestamp", [["thoi", "ngay", "gio", "timestamp"]]),
    ("muc_nuoc_thuong_luu", [["thuong"], ["nuoc"]]),
    ("muc_nuoc_dang_binh_thuong", [["dang", "binh"], ["nuoc"]]),
    ("muc_nuoc_chet", [["chet"], ["nuoc"]]),
    ("luu_luong_den_ho", [["luu"], ["den"]]),
    ("tong_luong_xa_qua_dap_tran", [["tong"], ["dap"]]),
    ("tong_luong_xa_qua_nha_may", [["tong"], ["nha"]]),
    ("tong_luong_xa", [["tong"], ["xa"]]),
    ("so_cua_xa_sau", [["so"], ["sau"]]),
    ("so_cua_xa_mat", [["so"], ["mat"]]),
]


def header_field(header: Column) -> Column:
    """Record field a table header stands for, NULL when none."""

    def rules(plain: Column) -> Column:
        out = None
        for field, groups in HEADER_RULES:
            holds = F.lit(True)
            for alternatives in groups:
                holds = holds & plain.rlike("|".join(alternatives))
            out = F.when(holds, field) if out is None else out.when(holds, field)
        return out

    return once(normalize_text(header), rules)


def expand_colspans(cells: Column) -> Column:
    """Texts of header cells ``array<struct<text, colspan>>``, each repeated by its span."""
    return F.flatten(F.transform(cells, lambda c: F.array_repeat(c["text"], c["colspan"])))


def looks_like_data(cells: Column, columns: Column | int) -> Column:
    """A row of texts is data when it holds a full date, or enough numeric cells."""
    cells = F.coalesce(cells, F.array().cast("array<string>"))
    # Fixed value: the pattern of a full date.
    has_date = F.array_join(cells, " ").rlike(r"\d{1,2}/\d{1,2}/(\d{2}|\d{4})")
    numeric = F.filter(
        cells, lambda c: F.btrim(F.translate(c, ",–", ""), F.lit(BLANKS)).rlike(f"{NUMBER}|^[+-]?[nN][aA][nN]$")
    )
    columns = F.lit(columns) if isinstance(columns, int) else columns
    return (F.size(cells) > 0) & (has_date | (F.size(numeric) >= F.greatest(F.lit(2), columns - 6)))
