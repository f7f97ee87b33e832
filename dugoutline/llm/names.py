"""Names, readings and teams as people type them, brought to comparable parts."""

from __future__ import annotations

import re

from dugoutline.llm.lookalikes import plain

# Older and variant kanji of names with the form they are compared in.
OLD_KANJI = str.maketrans(
    "濱澤邊邉瀧龍嶋嶌﨑嵜埼碕廣國關関瀨峯眞德學榮惠櫻檜淵渕淵髙齋齊斎圓藏鐵壽實曉應會黑靑豐彌萬禮與來晉顯縣藝當聲區條壯莊假價俠傳兒勳勵單嚴囑圍團增壘奧孃寬將專峽巖廳彈從惡戰拔擧擴敍晝曆條櫂樓樂權歷歸殘氣淨淸溪滿澁濕灣瀬燒獨獻獸畫疊發皓盡眞礦祿禪稻穗竝粹絲經綠緖縱總續繪繼缺聽膽臺與舊蔣藥蟲螢衞裝覽覺觀觸譯讀讓變豫賣賴轉辨遙遞遲邊鄕醫釀釋鑄鎭鑛鐵關陷險隱雜靈靜響頰顏餘驅驗驛體髮鬪鷄麥麵黃點黨齡",
    "浜沢辺辺滝竜島島崎崎崎崎広国関関瀬峰真徳学栄恵桜桧淵淵淵高斎斎斎円蔵鉄寿実暁応会黒青豊弥万礼与来晋顕県芸当声区条壮荘仮価侠伝児勲励単厳嘱囲団増塁奥嬢寛将専峡巌庁弾従悪戦抜挙拡叙昼暦条櫂楼楽権歴帰残気浄清渓満渋湿湾瀬焼独献獣画畳発皓尽真鉱禄禅稲穂並粋糸経緑緒縦総続絵継欠聴胆台与旧蒋薬虫蛍衛装覧覚観触訳読譲変予売頼転弁遥逓遅辺郷医醸釈鋳鎮鉱鉄関陥険隠雑霊静響頬顔余駆験駅体髪闘鶏麦麺黄点党齢",
)
HONORIFICS = r"(?:選手|投手|捕手|内野手|外野手|一塁手|二塁手|三塁手|遊撃手|主将|君|くん|さん|氏|様)"
_TAIL = re.compile(rf"\s*(?:[（(][^）)]*[）)]|{HONORIFICS})\s*$")
NICKNAME = re.compile(r"^(.*?)([ぁ-ゖァ-ヺー]+?)(?:ちゃん|っち|くん|チャン|ッチ|クン|やん|りん|坊|ぽん|ちん)$")
_ROMAN_INITIAL = re.compile(r"^(.*?)[\s,.・]*([A-Z])\.?$")
TEAM_HEAD = re.compile(r"^(?:\(株\)|㈱|株式会社|有限会社|県立|都立|道立|府立|市立|町立|私立|国立)")
TEAM_TAIL = re.compile(r"(?:株式会社|\(株\)|硬式野球部|軟式野球部|野球部|硬式|球団|クラブ|部|高等学校|高等部|高校|学校|大学校|大学|高|大|校)$")

_ROWS = {"": "あいうえお", "k": "かきくけこ", "s": "さしすせそ", "t": "たちつてと", "n": "なにぬねの", "h": "はひふへほ", "m": "まみむめも", "r": "らりるれろ", "g": "がぎぐげご", "z": "ざじずぜぞ", "d": "だぢづでど", "b": "ばびぶべぼ", "p": "ぱぴぷぺぽ"}
ROMAN = {c + v: k for c, row in _ROWS.items() for v, k in zip("aiueo", row, strict=True)}
ROMAN |= {"ya": "や", "yu": "ゆ", "yo": "よ", "wa": "わ", "wo": "を", "shi": "し", "chi": "ち", "tsu": "つ", "fu": "ふ", "ji": "じ"}
for _c, _k in {"ky": "き", "sh": "し", "ch": "ち", "ny": "に", "hy": "ひ", "my": "み", "ry": "り", "gy": "ぎ", "j": "じ", "by": "び", "py": "ぴ", "sy": "し", "ty": "ち", "zy": "じ", "jy": "じ"}.items():
    ROMAN |= {_c + v: _k + y for v, y in zip("auo", "ゃゅょ", strict=True)}
_LONG = re.compile("(?<=[おこそとのほもよろをごぞどぼぽょうくすつぬふむゆるぐずづぶぷゅ])う|(?<=[おこそとのほもよろごぞどぼぽょ])お|(?<=[いきしちにひみりぎじぢびぴえけせてねへめれげぜでべぺ])ー|ー")


def hiragana(text: str) -> str:
    return "".join(chr(ord(c) - 0x60) if "ァ" <= c <= "ヶ" else c for c in text)


def from_roman(text: str) -> str | None:
    """Reading of a romanised word; None where it isn't one."""
    t, out, i = text.lower().replace("'", ""), [], 0
    while i < len(t):
        for n in (3, 2, 1):
            if t[i : i + n] in ROMAN:
                out.append(ROMAN[t[i : i + n]])
                i += n
                break
        else:
            if t[i] in "nm":
                out.append("ん")
            elif i + 1 < len(t) and t[i] == t[i + 1]:
                out.append("っ")
            else:
                return None
            i += 1
    return "".join(out)


def short_vowels(reading: str) -> str:
    """Reading without long vowels, which romanised names lack."""
    return _LONG.sub("", reading)


def reading_of(text: str | None) -> str:
    """Hiragana of a kana or romanised text with its spaces, '' where it holds anything else."""
    if not text:
        return ""
    t = hiragana(re.sub(r"[\s・]+", " ", plain(text)).strip())
    if re.fullmatch(r"[ぁ-ゖー ]+", t):
        return t
    return ""


def surface(name: str) -> str:
    """A typed name in plain, current characters without titles, parts divided by one space."""
    t = re.sub(r"[\s・,，、/]+", " ", plain(name).translate(OLD_KANJI)).strip(" .?？!！")
    while (u := _TAIL.sub("", t)) != t and u:
        t = u
    return t.strip()


def parse_name(name: str | None, kana: str | None) -> dict:
    """Parts of a name: ``full`` without spaces, ``parts``, ``reading`` (short vowels), ``initial``, ``nick``, ``kind``."""
    t = surface(name or "")
    raw = plain(name or "")
    out = {"full": "", "parts": [], "reading": "", "initial": "", "nick": "", "kind": "kanji"}
    own = reading_of(kana)
    if re.fullmatch(r"[A-Za-z' .]+", t) and t:
        words = [w.strip(".") for w in t.split() if w.strip(".")]
        out["kind"] = "roman"
        if len(words) > 1 and len(words[-1]) == 1:
            out["initial"], words = words[-1].lower(), words[:-1]
        # the family name stands first after a comma, or is in capitals
        if len(words) == 2 and "," not in raw:
            if words[1].isupper() and not words[0].isupper():
                words.reverse()
        out["parts"] = [short_vowels(from_roman(w) or w.lower()) for w in words]
        out["full"] = "".join(out["parts"])
        out["reading"] = short_vowels(own.replace(" ", "")) or out["full"]
        return out
    if (m := _ROMAN_INITIAL.match(t)) and m[1]:
        out["initial"], t = m[2].lower(), m[1].strip(" .,")
    elif m := NICKNAME.match(t):
        if m[1].strip():
            out["nick"], t = short_vowels(hiragana(m[2])), m[1].strip()
    parts = t.split()
    if t and re.fullmatch(r"[ぁ-ゖァ-ヺー ]+", t):
        out["kind"] = "kana"
        parts = [short_vowels(hiragana(p)) for p in parts]
    out["parts"], out["full"] = parts, "".join(parts)
    if out["kind"] == "kana":
        out["reading"] = short_vowels(own.replace(" ", "")) or out["full"]
        return out
    # a given name typed in kana counts as its reading
    if m := re.fullmatch(r"([一-鿿々〆ヶケ㐀-䶿]+)([ぁ-ゖァ-ヺー]{2,})", out["full"]):
        out["nick"] = out["nick"] or short_vowels(hiragana(m[2]))
        out["parts"], out["full"] = [m[1]], m[1]
    out["reading"] = short_vowels(own.replace(" ", ""))
    return out


def team_key(team: str | None) -> str:
    """Team without legal forms, school types and space, in current characters."""
    t = re.sub(r"[\s・?？!！.,、。]+", "", plain(team or "").translate(OLD_KANJI))
    for _ in range(4):
        u = TEAM_HEAD.sub("", t)
        v = TEAM_TAIL.sub("", u)
        if v == t or len(v) < 2:
            break
        t = v
    return t


def edits(a: str, b: str, most: int = 3) -> int:
    """Edits between two short texts, a swap of neighbours counting one; ``most + 1`` where they are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            best = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            new.append(best)
        before, row = row, new
    return min(row[-1], most + 1)


def same_team(a: str, b: str) -> float:
    """1 for one team, less for a near spelling, 0 for another or none."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    if min(len(a), len(b)) >= 2 and (a.startswith(b) or b.startswith(a)):
        return 0.9
    if min(len(a), len(b)) >= 3 and edits(a, b, 1) == 1:
        return 0.8
    return 0.0
