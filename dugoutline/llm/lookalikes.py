"""Text that looks the same in other characters, brought to one plain form.

Skeleton: decompose (NFKD), drop what is not seen, replace every character by the prototype of a
look-alike table, decompose again. Text is shown in the composed form of its skeleton, which is the
identity on plain text; equal skeletons mean texts a reader can't tell apart.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters drawn like plain ones, by script, each followed by its prototype; in the order of code points.
LOOK_ALIKES = {
    "Cyrillic": "ЁE ЅS ІI ЇI ЈJ АA ВB ЕE З3 КK МM НH ОO РP СC ТT УY ХX Ьb аa вb гr еe кk мm нh оo пn рp сc тt уy хx ёe ѕs іi їi јj ѵv ҒF ғf ҮY үy Һh һh ӀI ӏl ԁd ԌG ԍg ԚQ ԛq ԜW ԝw",
    "Greek": "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX αa γy ιi κk νv οo ρp τt υu χx ϲc ϳj",
    "Armenian": "ԼL ՍU ՏS ՕO հh ոn սu ցg քp օo",
    "Cherokee": "ᎠD ᎡR ᎢT ᎥI ᎩY ᎪA ᎫJ ᎬE ᎳW ᎷM ᎻH ᏀG ᏂH ᏃZ ᏏB ᏒR ᏔW ᏙV ᏚS ᏞL ᏟC ᏢP ᏦK ᏧD ᏳG ᏴB",
    "Lisu": "ꓐB ꓑP ꓔT ꓗK ꓜZ ꓝF ꓟM ꓠN ꓢS ꓣR ꓦV ꓧH ꓪW ꓫX ꓬY ꓮA ꓰE ꓲI ꓳO ꓴU",
    "Latin": "ıi ȷj ɑa ɡg ɢG ɩi ɪI ʀR ʏy ʙB ʜH ʟL",
}
LETTERS = {pair[0]: pair[1:] for pairs in LOOK_ALIKES.values() for pair in pairs.split()}
# Signs and dashes drawn like plain ones.
SIGNS = {
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "′": "'", "ʼ": "'", "ʹ": "'", "`": "`", "“": '"', "”": '"', "„": '"', "‟": '"', "″": '"', "〝": '"', "〟": '"',
    "⁄": "/", "∕": "/", "∶": ":", "ː": ":", "։": ":", "․": ".", "‧": "・", "·": "・", "•": "・", "∙": "・", "⋅": "・", "‹": "<", "›": ">", "〈": "<", "〉": ">",
    "∗": "*", "⁎": "*", "∼": "~", "〜": "~", "˜": "~", "∣": "|", "ǀ": "|", "│": "|", "¦": "|", "⼁": "|", "〇": "〇", "、": "、", "﹑": "、", "､": "、", "｡": "。",
}
DASHES = "‐‑‒–—―−─━﹘﹣－⁃˗➖"
#: Kanji and hiragana drawn like katakana; they count as such only inside a katakana word.
KANA_TWINS = dict(zip("力口工夕八卜二一へべぺ", "カロエタハトニーヘベペ", strict=True))
_UNSEEN = re.compile("[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\U000e0000-\U000e0fff\U0001bca0-\U0001bca3\u0000-\u0008\u000e-\u001f\u007f-\u0084\u0086-\u009f]")
_TABLE = {ord(k): v for k, v in {**LETTERS, **SIGNS}.items()}
_SPACES = re.compile(r"[^\S\t\n\r ]")
_DASH = re.compile(f"([ァ-ヺーｦ-ﾟ]|[カ-ト]\u3099|[ハ-ホ][\u3099\u309a])?[{DASHES}]")
_BETWEEN = re.compile(r"(?<=[ァ-ヺー])[力口工夕八卜二一へべぺ](?=[ァ-ヺー])")
_START = re.compile(r"(?<![ァ-ヺー一-鿿])[力口工夕卜](?=[ァ-ヺー])(?!コミ|ポイ)|(?<![ァ-ヺー])[力口工夕卜](?=[ーンッァィゥェォャュョ])|(?<![ァ-ヺー])[二八一へべぺ](?=[ーンッァィゥェォャュョ][ァ-ヺー])")
_END = re.compile(r"(?<=[ァ-ヺー])(?:[口夕](?![一-鿿ァ-ヺー])|卜|一(?=[はがをのもとでにへや、。」]))")
_INSIDE_NUMBER = re.compile(r"(?<=\d)[OolI](?=\d)")

#: Rows that match may hold a case; all others are plain (Java regex).
SUSPECT = r"[^\t\n\r -~ぁ-ゖァ-ヺ・ー、。「」『』【】々〆〇ゝゞヽヾ一-鿿㐀-䶿]|[ァ-ヺー][力口工夕八卜二一へべぺ]|[力口工夕八卜二一へべぺ][ァ-ヺー]|[0-9][OolI][0-9]"


def plain(text: str) -> str:
    """The composed skeleton of ``text``."""
    d = _DASH.sub(lambda m: f"{m[1]}ー" if m[1] else "-", _UNSEEN.sub("", text))
    d = _UNSEEN.sub("", unicodedata.normalize("NFKD", d))
    d = _SPACES.sub(" ", d.replace("\u2028", "\n").replace("\u2029", "\n").replace("\x85", "\n")).translate(_TABLE)
    d = unicodedata.normalize("NFKC", d)
    for _ in range(8):
        e = _BETWEEN.sub(lambda m: KANA_TWINS[m[0]], d)
        e = _START.sub(lambda m: KANA_TWINS[m[0]], e)
        e = _END.sub(lambda m: KANA_TWINS[m[0]], e)
        if e == d:
            break
        d = e
    return _INSIDE_NUMBER.sub(lambda m: "0" if m[0] in "Oo" else "1", d)


def skeleton(text: str) -> str:
    """Decomposed form of ``plain``, by which look-alikes are equal."""
    return unicodedata.normalize("NFD", plain(text))


def _forms(text: Column | str) -> Column:
    """(skeleton, plain) of a text."""

    @F.pandas_udf("skeleton string, plain string")
    def run(x: pd.Series) -> pd.DataFrame:
        forms = [None if t is None else plain(t) for t in x]
        return pd.DataFrame({"skeleton": pd.Series([None if p is None else unicodedata.normalize("NFD", p) for p in forms], dtype=object), "plain": pd.Series(forms, dtype=object)})

    # a filter on the result must not run it a second time
    return run.asNondeterministic()(text)


def lookalike_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(record_id, text, skeleton, plain) of the rows whose text has a look-alike or unseen character.

    Texts of one skeleton are one group, and its plain text is the composed skeleton; a row is a case if its text is
    another one of the group. The skeleton tells the plain text, so that needs no other row of the group. Nulls and
    blanks are no case; repeated rows each give a row. An empty table gives none.
    """
    suspects = df.select(F.col(id_col).alias("record_id"), F.col(text_col).alias("text")).where(F.col("text").rlike(SUSPECT))
    return suspects.withColumn("_forms", _forms("text")).select("record_id", "text", "_forms.*").where("plain <> text")


def skeleton_groups(df: DataFrame, text_col: str) -> DataFrame:
    """Spellings that look alike: one row per skeleton with its plain form, its spellings' number and rows.

    Equal texts are counted before skeletons are gathered, so a hot text is one row in the shuffle. Null texts are
    left out; an empty table gives no row.
    """
    spelt = df.where(F.col(text_col).isNotNull()).groupBy(F.col(text_col).alias("text")).agg(F.count("*").alias("n"))
    formed = spelt.withColumn("_forms", _forms("text")).select("_forms.*", "n")
    return formed.groupBy("skeleton").agg(F.first("plain").alias("plain"), F.count("*").alias("spellings"), F.sum("n").alias("records")).drop("skeleton")
