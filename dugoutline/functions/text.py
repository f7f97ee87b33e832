"""Column expressions that normalise names, schools, clubs and texts; null stays null unless said."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from dugoutline.functions import values as V

#: White space as the domain's texts have it, spelt out because regex engines differ.
SPACE = r"[\t\n\x0b\f\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_WIDE = "０１２３４５６７８９"


def literal_map(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def looked_up(table: dict, key: Column) -> Column:
    return F.try_element_at(literal_map(table), key)


def translated(text: Column, table: dict[str, str]) -> Column:
    return F.translate(text, "".join(table), "".join(table.values()))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def nfkc(text: Column) -> Column:
    """Compatibility form; only texts with other than plain ASCII and kana or kanji go to Python."""

    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    return F.when(text.rlike(r"[^\x00-\x7Fぁ-ゖァ-ヺー一-鿿、。「」『』【】・]"), run(text)).otherwise(text)


def current_characters(text: Column, table: dict[str, str] | None = None) -> Column:
    return translated(nfkc(text), table or V.VARIANTS)


def player_key(name: Column) -> Column:
    """Current characters without white space and one title, in lower case; null where nothing is left."""
    bare = F.regexp_replace(current_characters(name), SPACE, "")
    return F.nullif(F.lower(F.regexp_replace(bare, "(?:選手|くん|君|さん)$", "")), F.lit(""))


def name_key(name: Column) -> Column:
    return F.coalesce(translated(player_key(name), V.MORE_VARIANTS), F.lit(""))


def school_form(text: Column, aliases: dict[str, str] | None = None) -> Column:
    """School key of a text already in current characters."""
    bare = F.regexp_replace(text, SPACE, "")
    short = F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, "大學$", "大"), "大学$", "大"), "(?:高等学校|高校)$", "高")
    known = V.SCHOOL_ALIASES if aliases is None else aliases
    return F.nullif(F.lower(F.coalesce(looked_up({k: "".join(V.VARIANTS.get(c, c) for c in v) for k, v in known.items()}, short), short)), F.lit(""))


def school_key(team: Column, aliases: dict[str, str] | None = None) -> Column:
    """School without white space, its kind shortened, aliases resolved; alias targets are folded too, so that they equal the
    full name's key."""
    return school_form(current_characters(team), aliases)


def school_match_key(team: Column) -> Column:
    return F.coalesce(F.translate(school_key(team), "附ヶヵ", "付ケケ"), F.lit(""))


def kana_key(kana: Column) -> Column:
    """Hiragana and long marks of a reading; '' for none."""
    shift = {chr(c): chr(c - 0x60) for c in range(0x30A1, 0x30F7)}
    return F.coalesce(F.regexp_replace(translated(nfkc(kana), shift), "[^ぁ-んー]", ""), F.lit(""))


def club_key(team: Column, table: dict[str, str] | None = None) -> Column:
    """Key of a club: exact spelling, else the longest known spelling that the text contains."""
    table = V.CLUB_KEYS if table is None else table
    name = strip(team)
    part = [F.when(name.contains(k), F.lit(v)) for k, v in sorted(table.items(), key=lambda kv: -len(kv[0]))]
    return F.coalesce(looked_up(table, name), *part)


def club_name(key: Column, table: dict[str, str] | None = None, order: tuple[str, ...] = V.CLUB_NAMES) -> Column:
    """Display name of a club key; null for blank and 'other', an unknown key as it is."""
    table = V.CLUB_KEYS if table is None else table
    names: dict[str, str] = {}
    for n in order:
        names.setdefault(table[n], n)
    k = strip(key)
    return F.when((k != "") & (k != "other"), F.coalesce(looked_up(names, k), k))


def clean_text(text: Column) -> Column:
    """Trimmed with single spaces; '' for null."""
    return F.coalesce(F.regexp_replace(strip(text), f"{SPACE}+", " "), F.lit(""))


def comment_text(comment: Column) -> Column:
    """Comment without outer quotes and with single spaces; '' for null."""
    quotes = "「『“”\"'", "」』“”\"'"
    bare = F.regexp_replace(F.regexp_replace(strip(comment), f"^(?:[{quotes[0]}]|{SPACE})+", ""), f"(?:[{quotes[1]}]|{SPACE})+$", "")
    return F.coalesce(strip(F.regexp_replace(bare, f"{SPACE}+", " ")), F.lit(""))


def comment_key(comment: Column) -> Column:
    return F.lower(comment_text(comment))


def loose_comment_key(comment: Column) -> Column:
    """Only ASCII letters and digits, kana and kanji of the lower case comment."""
    return F.regexp_replace(comment_key(comment), "[^0-9a-z\\u3040-\\u30ff\\u3400-\\u9fff\\uff66-\\uff9f]", "")


def number_of(text: Column) -> Column:
    """Integer of half- or full-width digits or a kanji number to twelve."""
    t = F.translate(strip(text), _WIDE, "0123456789")
    return F.coalesce(F.when(t.rlike("^[0-9]+$"), t.try_cast("int")), looked_up(V.KANJI_NUMBERS, t))


def to_int(text: Column) -> Column:
    """Whole number of a text, else null."""
    t = strip(text)
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("int"))


def category_of(text: Column) -> Column:
    t = blank_to_null(text)
    return F.when(t.contains("高校"), "高校").when(t.contains("大学"), "大学").when(t.contains("社会人"), "社会人").when(t.contains("独立"), "独立リーグ").otherwise(t)


def positions_of(values: Column) -> Column:
    """Canonical positions of an array, each once, in order; null gives an empty array."""
    def one(x: Column) -> Column:
        out = None
        for canonical, words in V.POSITIONS.items():
            hit = x.rlike("|".join(words))
            out = F.when(hit, canonical) if out is None else out.when(hit, canonical)
        return out.otherwise(x)

    cleaned = F.filter(F.transform(values, clean_text), lambda x: x != "")
    return F.coalesce(F.array_distinct(F.transform(cleaned, one)), F.array().cast("array<string>"))


def throws_of(text: Column) -> Column:
    t = blank_to_null(text)
    return F.when((F.upper(t) == "R") | t.contains("右"), "R").when((F.upper(t) == "L") | t.contains("左"), "L")


def bats_of(text: Column) -> Column:
    t = blank_to_null(text)
    return F.when((F.upper(t) == "S") | t.contains("両") | t.contains("スイッチ"), "S").otherwise(throws_of(text))


def source_priority(source: Column, table: dict[str, int] | None = None) -> Column:
    return F.coalesce(looked_up(V.SOURCE_PRIORITIES if table is None else table, source), F.lit(5))


def rank_label(code: Column) -> Column:
    """Letter of a rank code 90..30 in tens, else a dash."""
    return F.coalesce(looked_up({90 - 10 * i: c for i, c in enumerate("SABCDEF")}, code), F.lit("—"))


def content_md5(title: Column, body: Column) -> Column:
    """Digest that tells equal articles: title and body with single spaces, on two lines."""
    return F.md5(F.concat(clean_text(title), F.lit("\n"), clean_text(body)))


def content_sha256(title: Column, body: Column) -> Column:
    """Digest that is stored: title and body as one line with single spaces."""
    return F.sha2(clean_text(F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(body, F.lit("")))), 256)


def title_hash(title: Column, evidence: Column) -> Column:
    return F.md5(F.regexp_replace(F.coalesce(F.nullif(title, F.lit("")), evidence, F.lit("")), SPACE, ""))


def plain_excerpt(text: Column) -> Column:
    """Markdown links and marks removed, single spaces; null where nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(text, r"\[([^\]]*)\]\([^)]*\)", "$1"), r"[#*_`>~]", "")
    return F.nullif(clean_text(bare), F.lit(""))


def topic_key(kind: Column, *, year=None, player=None, date=None, team=None, team_b=None, category=None, theme=None, title=None) -> Column:
    """Key of a topic by kind; null where a part it needs is missing, 'unknown' for a missing year."""
    none = F.lit(None).cast("string")
    player, date, team, team_b, category, theme, title = (none if x is None else F.nullif(x.cast("string"), F.lit("")) for x in (player, date, team, team_b, category, theme, title))
    y = F.coalesce((none if year is None else year).cast("string"), F.lit("unknown"))
    join = lambda *parts: F.when(F.forall(F.array(*parts), lambda p: p.isNotNull()), F.concat_ws(":", *parts))
    return (
        F.when(kind == "player_watch", join(F.lit("player_watch"), y, player, date))
        .when(kind == "scout_meeting", join(F.lit("scout_meeting"), team, date, y))
        .when(kind == "game_report", F.when(team.isNotNull() & team_b.isNotNull(), join(F.lit("game_report"), date, F.least(team, team_b), F.greatest(team, team_b))))
        .when(kind == "ranking", join(F.lit("ranking"), y, category, theme))
        .when(kind == "other", join(F.lit("other"), title))
    )


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    """Whether a text holds any of the words; False for null."""
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return F.coalesce(hit, F.lit(False))


def contains_any_case(text: Column, words: tuple[str, ...]) -> Column:
    """Whether a text holds any of the words, in letters of either case; False for null."""
    return contains_any(F.lower(text), tuple(w.lower() for w in words))


def position_list(text: Column) -> Column:
    """Positions of a text that names one or two: a pitcher with the other kind, else the first kind that it names, else
    the text; null for blank."""
    has = lambda p: text.contains(p)
    out = F.when(strip(text) == "", F.lit(None))
    for other in ("外野手", "内野手", "捕手"):
        out = out.when(has("投手") & has(other), F.array(F.lit("投手"), F.lit(other)))
    for one in ("捕手", "内野手", "外野手", "投手"):
        out = out.when(has(one), F.array(F.lit(one)))
    return out.when(text.isNotNull(), F.array(text))


def inserted_values(table: str, columns: dict[str, Column]) -> Column:
    """SQL text that inserts a row: texts quoted with their quotes doubled, nulls as NULL."""
    value = lambda c: F.coalesce(F.concat(F.lit("'"), F.replace(c.cast("string"), F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))
    return F.concat(F.lit(f"INSERT INTO {table} ({', '.join(columns)}) VALUES ("), F.concat_ws(", ", *[value(c) for c in columns.values()]), F.lit(");"))


def spaced_name(name: Column) -> Column:
    """Name with single half-width spaces; '' for null."""
    return F.coalesce(strip(F.regexp_replace(name, f"{SPACE}+", " ")), F.lit(""))


def name_variations(name: Column) -> Column:
    """The name, the name without spaces, and a name without one with a space at every place; each once, sorted."""
    n = spaced_name(name)
    bare = F.replace(n, F.lit(" "), F.lit(""))
    size = F.length(n)
    split = F.when((n == bare) & (size >= 2), F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.concat(F.substring(n, F.lit(1), i), F.lit(" "), F.substring(n, i + 1, size)))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.concat(F.array(n, bare), split)))


def federation_label(affiliation: Column) -> Column:
    """Federation without its generic ending; a dash for null and blank."""
    given = F.nullif(affiliation, F.lit(""))
    return F.coalesce(F.nullif(F.regexp_replace(given, "(?:野球)?連盟$", ""), F.lit("")), given, F.lit("—"))


def known_club(key: Column, clubs: tuple[str, ...], aliases: dict[str, str] | None = None) -> Column:
    """Key of a club in lower case, aliases resolved; null for keys that aren't among the clubs."""
    k = F.lower(strip(key))
    k = F.coalesce(looked_up(aliases, k), k) if aliases else k
    return F.when(k.isin(*clubs), k)


def entry_key(category: Column, name: Column, school: Column) -> Column:
    return F.concat_ws("|", F.coalesce(category, F.lit("")), name_key(name), school_match_key(school))


def article_url(url: Column, site: str, path: str = "/articles/") -> Column:
    """Whether a URL is an article of the site; False for null."""
    return F.coalesce(url.startswith(site) & url.contains(path), F.lit(False))


def placeholder_title(kind: Column, player: Column, teams: Column, persons: Column, title: Column) -> Column:
    """Title of a topic until it is written about."""
    crowd = F.when((F.coalesce(teams, F.lit(0)) > 0) | (F.coalesce(persons, F.lit(0)) > 0), F.concat(player, F.lit("にスカウト視察集中（"), F.coalesce(teams, F.lit(0)).cast("string"), F.lit("球団"), F.coalesce(persons, F.lit(0)).cast("string"), F.lit("人）"))).otherwise(F.concat(player, F.lit("にスカウトの注目集まる")))
    named = (kind == "player_watch") & (F.coalesce(player, F.lit("")) != "")
    return F.when(named, crowd).when(kind == "scout_meeting", F.lit("スカウト会議・編成動向まとめ")).otherwise(F.coalesce(F.nullif(title, F.lit("")), F.lit("ドラフト関連トピック")))


def checked_keys(markdown: Column) -> Column:
    """Keys of the ticked lines of a checklist."""
    return F.coalesce(F.array_distinct(F.regexp_extract_all(markdown, F.lit(r"(?i)- \[x\][^\n]*<!--k:([^>]+?)-->"), F.lit(1))), F.array().cast("array<string>"))


def in_season(day: Column, until: str) -> Column:
    """Whether a day's month and day are no later than ``until`` (MM-dd)."""
    return F.date_format(day, "MM-dd") <= F.lit(until)
