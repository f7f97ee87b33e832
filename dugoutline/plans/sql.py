"""DuckDB expressions with the meaning of the column functions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from dugoutline.functions import values as V
from dugoutline.functions.dates import NOTATIONS

SPACE = r"[\t\n\v\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {quote(pattern)}, {quote(to)}, 'g')"


def hit(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {quote(pattern)})"


def strip(x: str) -> str:
    return sub(x, f"^{SPACE}+|{SPACE}+$", "")


def clean(x: str) -> str:
    return f"coalesce({sub(strip(x), SPACE + '+', ' ')}, '')"


def comment_text(x: str) -> str:
    head = sub(strip(x), f"^(?:[「『“”\"']|{SPACE})+", "")
    return f"coalesce({strip(sub(sub(head, f'(?:[」』“”{chr(34)}{chr(39)}]|{SPACE})+$', ''), SPACE + '+', ' '))}, '')"


def loose(x: str) -> str:
    return sub(f"lower({comment_text(x)})", r"[^0-9a-z\x{3040}-\x{30ff}\x{3400}-\x{9fff}\x{ff66}-\x{ff9f}]", "")


def case(x: str, table: dict, other: str = "null") -> str:
    value = lambda v: quote(v) if isinstance(v, str) else str(v)
    return f"case {x} {' '.join(f'when {value(k)} then {value(v)}' for k, v in table.items())} else {other} end"


def contains_any(x: str, words) -> str:
    return "coalesce(" + " or ".join(f"contains({x}, {quote(w)})" for w in words) + ", false)"


def club_key(x: str, table: dict) -> str:
    part = " ".join(f"when contains({strip(x)}, {quote(k)}) then {quote(v)}" for k, v in sorted(table.items(), key=lambda kv: -len(kv[0])))
    return f"coalesce({case(strip(x), table)}, case {part} end)"


def category(x: str) -> str:
    t = f"nullif({strip(x)}, '')"
    return f"case when contains({t}, '高校') then '高校' when contains({t}, '大学') then '大学' when contains({t}, '社会人') then '社会人' when contains({t}, '独立') then '独立リーグ' else {t} end"


def number(x: str) -> str:
    digits = f"translate({strip(x)}, '０１２３４５６７８９', '0123456789')"
    return f"coalesce(case when {hit(digits, '^[0-9]+$')} then try_cast({digits} as int) end, {case(digits, V.KANJI_NUMBERS)})"


def day(x: str) -> str:
    """UTC day of an instant."""
    return f"date '1970-01-01' + cast(floor(epoch_us({x}) / 86400000000) as int)"


def attention(s: str) -> str:
    scouting = hit(s, V.SCOUTING)
    return (
        f"({hit(s, V.ATTENTION)} and not {hit(s, V.OFF_TOPIC)} and not (contains({s}, '集結') and not {hit(s, V.GATHERING)}) and not (contains({s}, '全球団') and not {scouting})"
        f" and not ({hit(s, f'(?:{V.COUNT}|全球団|12|１２|十二)球団')} and not {scouting}))"
    )


@lru_cache(maxsize=1)
def _compatible() -> tuple[str, str, dict[str, str]]:
    """Characters with a compatibility form: those of one character with it, and those of several."""
    one, many = {}, {}
    for c in map(chr, (*range(0x80, 0xD800), *range(0xF900, 0xFB50), *range(0xFE00, 0xFE70), *range(0xFF00, 0xFFF0))):
        d = unicodedata.normalize("NFKD", c)
        if d != unicodedata.normalize("NFD", c):
            (one if len(d) == 1 else many)[c] = d
    return "".join(one), "".join(one.values()), many


def nfkc(x: str) -> str:
    """Compatibility form of a text; ASCII and plain kana and kanji are left as they are."""
    one, to, many = _compatible()
    table = "map {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in many.items()) + "}"
    singles = f"translate({x}, {quote(one)}, {quote(to)})"
    spread = f"array_to_string(list_transform(regexp_extract_all({singles}, '(?s).'), lambda c: coalesce({table}[c], c)), '')"
    plain = hit(x, r"^[\x00-\x7Fぁ-ゖァ-ヺー一-鿿、。「」『』【】・]*$")
    return f"case when {plain} then {x} else nfc_normalize({spread}) end"


def translated(x: str, table: dict[str, str]) -> str:
    return f"translate({x}, {quote(''.join(table))}, {quote(''.join(table.values()))})"


def player_key(x: str) -> str:
    bare = sub(translated(nfkc(x), V.VARIANTS), SPACE, "")
    return f"nullif(lower({sub(bare, '(?:選手|くん|君|さん)$', '')}), '')"


def name_key(x: str) -> str:
    return f"coalesce({translated(player_key(x), V.MORE_VARIANTS)}, '')"


def kana_key(x: str) -> str:
    shift = {chr(c): chr(c - 0x60) for c in range(0x30A1, 0x30F7)}
    return f"coalesce({sub(translated(nfkc(x), shift), '[^ぁ-んー]', '')}, '')"


def school_key(x: str) -> str:
    bare = sub(translated(nfkc(x), V.VARIANTS), SPACE, "")
    short = sub(sub(bare, "(?:大學|大学)$", "大"), "(?:高等学校|高校)$", "高")
    known = {k: "".join(V.VARIANTS.get(c, c) for c in v) for k, v in V.SCHOOL_ALIASES.items()}
    return f"(select nullif(lower({case('s', known, 's')}), '') from (select {short} as s))"


def school_match_key(x: str) -> str:
    return f"coalesce(translate({school_key(x)}, '附ヶヵ', '付ケケ'), '')"


def wall_clock(x: str) -> str:
    """Clock of a date text by the fixed notations."""
    t = strip(sub(strip(x), r"^\[|\]$", ""))
    out = []
    for pattern, groups, kept in NOTATIONS:
        part = lambda i, pattern=pattern: f"regexp_extract({t}, {quote(pattern)}, {i})"
        y, *rest = groups
        built = " || ".join([part(y), *[f"'{mark}' || " + (f"lpad(coalesce(nullif({part(i)}, ''), '0'), 2, '0')" if i else "'00'") for mark, i in zip("-- ::", rest, strict=True)]])
        out.append(f"case when {hit(t, pattern)} then {built} end" if kept else f"case when {hit(t, pattern)} and try_cast({built} as timestamp) is not null then {built} end")
    return f"coalesce({', '.join(out)})"


def instant_text(x: str) -> str:
    """A timestamp as its clock in Japan with the offset."""
    return f"strftime(make_timestamp(epoch_us({x}) + 32400000000), '%Y-%m-%dT%H:%M:%S+09:00')"
