"""What a text looks like: one key for all spellings that cannot be told apart by eye.

Two texts look the same when they differ only in width or presentation forms, in composed or separate marks, in
invisible characters, in the kind of a blank, or in letters of the same shape at that place of a word.
"""

from __future__ import annotations

import re
import unicodedata

# Characters with the property White_Space, and those of them that end a line.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_ENDS = "\n\x0b\x0c\r\x85\u2028\u2029"
# Letters that look like the Latin letter in the same position of the second string.
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳονιρυκ", "ABEZHIKMNOPTYXCjovipuk")
CYRILLIC = ("АВЕЅІЈКМНОРСТУХԌԚԜаеѕіјорсухһԁԛԝѵ", "ABESIJKMHOPCTYXGQWaesijopcyxhdqwv")
ARMENIAN = ("օՕսՍհոզԼցՏյ", "oOuUhnqLgSj")
CHEROKEE = ("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᎽᏀᏃᏙᏚᏞᏟᏢᏦᏴ", "DRTAJEWMHYGZVSLCPKB")
LISU = ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU")
COPTIC = ("ⲀⲂⲈⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ", "ABEHIKMNOPCTYXopc")
# Arabic-script letters of other languages that take the shape of a basic letter where they are joined on (yeh, keheh, heh goal,
# heh doachashmee), and where they are not (yeh, heh goal, ae, teh marbuta is none of them).
JOINED = ("یکہھ", "يكهه")
UNJOINED = ("یہە", "ىهه")

ZWNJ, SOFT_HYPHEN = "\u200c", "\u00ad"
_ARABIC = "ؠ-يٮٯٱ-ۓۺ-ۿ"
_MARKS = "ؐ-ًؚ-ٰٟۖ-ۜ۟-۪ۤۧۨ-ۭ"
_JOINING = "ئبت-خس-ؿـ-هىيٹ-ڇښ-ڿہۂیێ"
_KEPT = "\uf8f0"  # stands for a non-joiner that shows


def invisible_characters() -> str:
    """Characters without a glyph: format characters (but for the Arabic number signs), variation selectors and fillers."""
    own = [chr(c) for c in (*range(0xFFFE), *range(0xE0000, 0xE0200), *range(0x1D173, 0x1D17B)) if unicodedata.category(chr(c)) == "Cf" and not 0x600 <= c <= 0x605 and c not in (0x6DD, 0x70F, 0x890, 0x891, 0x8E2)]
    selectors = [chr(c) for c in (*range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0), *range(0x180B, 0x180E))]
    return "".join(dict.fromkeys([*own, *selectors, "͏", "ᅟ", "ᅠ", "឴", "឵", "ㅤ", "ﾠ"]))


def presentation_forms() -> dict[str, str]:
    """Width and presentation forms and what they stand for."""
    out = {}
    for first, last in ((0xFB00, 0xFDFF), (0xFE70, 0xFEFE), (0xFF01, 0xFFEF)):
        for c in range(first, last + 1):
            plain = unicodedata.normalize("NFKC", chr(c))
            if plain != chr(c):
                out[chr(c)] = plain.lstrip() or plain
    for c in (*range(0x2100, 0x2189), *range(0x1D400, 0x1D800)):  # letters and digits of another face, and Roman numerals
        if unicodedata.decomposition(chr(c)).startswith("<font>") or 0x2160 <= c < 0x2180:
            out[chr(c)] = unicodedata.normalize("NFKC", chr(c))
    return out


INVISIBLE = invisible_characters()
FORMS = presentation_forms() | {c: "\n" if c in LINE_ENDS else " " for c in BLANKS} | dict.fromkeys(INVISIBLE, "")
LOOKS = {a: b for pair in (GREEK, CYRILLIC, ARMENIAN, CHEROKEE, LISU, COPTIC) for a, b in zip(*pair)}
_HOLD = re.compile(f"(?<=[{_JOINING}])([{_MARKS}]*){ZWNJ}(?=[{_ARABIC}])")
_SOFT = re.compile(f"{SOFT_HYPHEN}(?=[{LINE_ENDS}])")
_NEXT = f"[{_MARKS}]*[{_ARABIC}]"
_ARABIC_LOOKS = [(re.compile(f"{a}(?={_NEXT})"), a, b) for a, b in zip(*JOINED)] + [(re.compile(f"{a}(?!{_NEXT})"), a, b) for a, b in zip(*UNJOINED)]
#: Characters that stay as they are unless a combining mark follows.
_PLAIN = frozenset(map(chr, (10, *range(32, 127), *range(0xA1, 0xAD), *range(0xAE, 0x180), 0x60C, 0x61B, 0x61F, *range(0x621, 0x653), *range(0x660, 0x66E), *range(0x2010, 0x2028), *range(0x2030, 0x203F))))


def unfold(text: str) -> str:
    """Width, presentation forms, blanks, invisible characters and composition brought to one form; letters stay.

    A non-joiner between two letters that would join shows, so it stays; so does a soft hyphen at a line end.
    """
    if ZWNJ in text:
        text = _HOLD.sub(r"\1" + _KEPT, text)
    if SOFT_HYPHEN in text:
        text = _SOFT.sub("¬", text)
    if "\r\n" in text:
        text = text.replace("\r\n", "\n")
    for c in set(text):
        if c not in _PLAIN and (to := FORMS.get(c)) is not None:
            text = text.replace(c, to)
    return unicodedata.normalize("NFC", text).replace(_KEPT, ZWNJ)


def is_plain(text: str) -> bool:
    """Whether text is sure to be its own key."""
    return text.isascii() and "\r" not in text and "\t" not in text and "\x0b" not in text and "\x0c" not in text or _PLAIN.issuperset(text)


def visual_key(text: str) -> str:
    """One spelling for all texts that look like this one. '' for ''."""
    if is_plain(text):
        return text
    text = unfold(text)
    for c in set(text):
        if c not in _PLAIN and (to := LOOKS.get(c)) is not None:
            text = text.replace(c, to)
    for pattern, a, b in _ARABIC_LOOKS:
        if a in text:
            text = pattern.sub(b, text)
    return text
