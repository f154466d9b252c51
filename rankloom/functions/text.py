"""Words of a text, and A2's one-byte document length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode word-break classes (UAX #29) as far as words need them.
IDEOGRAPH = (r"\u3005\u3007\u3021-\u3029\u3038-\u303B\u3041-\u3096\u309D-\u309F"
             r"\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}")
KATAKANA = r"\u3031-\u3035\u309B\u309C\u30A0-\u30FA\u30FC-\u30FF\u31F0-\u31FF\u32D0-\u32FE\u3300-\u3357\uFF66-\uFF9D\x{1B000}"
# Scripts without blanks between words: Thai, Lao, Myanmar, Khmer, Tai Le, New Tai Lue, Tai Tham, Tai Viet, Ahom.
UNSPACED = (r"[\p{IsThai}\p{IsLao}\p{IsMyanmar}\p{IsKhmer}\p{IsTai_Le}\p{IsNew_Tai_Lue}\p{IsTai_Tham}"
            r"\p{IsTai_Viet}\p{IsAhom}&&[\p{L}\p{M}]]")
# Extended pictographs, their skin tones, the letters of flags, and the tags and signs of sequences.
PICTOGRAPH = (r"\u00A9\u00AE\u203C\u2049\u2122\u2139\u2194-\u2199\u21A9\u21AA\u231A\u231B\u2328\u2388\u23CF\u23E9-\u23F3"
              r"\u23F8-\u23FA\u24C2\u25AA\u25AB\u25B6\u25C0\u25FB-\u25FE\u2600-\u2605\u2607-\u2612\u2614-\u2685\u2690-\u2705"
              r"\u2708-\u2712\u2714\u2716\u271D\u2721\u2728\u2733\u2734\u2744\u2747\u274C\u274E\u2753-\u2755\u2757"
              r"\u2763-\u2767\u2795-\u2797\u27A1\u27B0\u27BF\u2934\u2935\u2B05-\u2B07\u2B1B\u2B1C\u2B50\u2B55\u3030\u303D"
              r"\u3297\u3299\x{1F000}-\x{1F0FF}\x{1F10D}-\x{1F10F}\x{1F12F}\x{1F16C}-\x{1F171}\x{1F17E}\x{1F17F}\x{1F18E}"
              r"\x{1F191}-\x{1F19A}\x{1F1AD}-\x{1F1E5}\x{1F201}-\x{1F20F}\x{1F21A}\x{1F22F}\x{1F232}-\x{1F23A}"
              r"\x{1F23C}-\x{1F23F}\x{1F249}-\x{1F3FA}\x{1F400}-\x{1F53D}\x{1F546}-\x{1F64F}\x{1F680}-\x{1F6FF}"
              r"\x{1F774}-\x{1F77F}\x{1F7D5}-\x{1F7FF}\x{1F80C}-\x{1F80F}\x{1F848}-\x{1F84F}\x{1F85A}-\x{1F85F}"
              r"\x{1F888}-\x{1F88F}\x{1F8AE}-\x{1F8FF}\x{1F90C}-\x{1F93A}\x{1F93C}-\x{1F945}\x{1F947}-\x{1FAFF}\x{1FC00}-\x{1FFFD}")
SKIN_TONE = r"\x{1F3FB}-\x{1F3FF}"
FLAG_LETTER = r"\x{1F1E6}-\x{1F1FF}"
TAG = r"\x{E0020}-\x{E007F}"
KEYCAP = r"\uFE0F?\u20E3"
# Scripts whose letters do not join with those of others.
_APART = rf"{IDEOGRAPH}{KATAKANA}\uFF9E\uFF9F\p{{IsThai}}\p{{IsLao}}\p{{IsMyanmar}}\p{{IsKhmer}}\p{{IsTai_Le}}\p{{IsNew_Tai_Lue}}\p{{IsTai_Tham}}\p{{IsTai_Viet}}\p{{IsAhom}}"
LETTER = rf"[\p{{L}}\p{{Nl}}&&[^{_APART}]]"
DIGIT = r"\p{Nd}"
CONNECTOR = r"\p{Pc}"
EXTENDER = r"\p{M}\u200C\u200D\u00AD\uFF9E\uFF9F"
INSIDE_WORD = (r"[.'\u2018\u2019\u2024\uFE52\uFF07\uFF0E"
               r":\u00B7\u0387\u05F4\u2027\uFE13\uFE55\uFF1A]")
INSIDE_NUMBER = (r"[.'\u2018\u2019\u2024\uFE52\uFF07\uFF0E"
                 r",;\u037E\u0589\u060C\u060D\u066C\u07F8\u2044"
                 r"\uFE10\uFE14\uFE50\uFE54\uFF0C\uFF1B]")
# Longer words are cut into pieces of this many characters.
MAX_WORD = 255

# Digits join with letters in any script.
_START = rf"[[\p{{L}}\p{{Nl}}&&[^{_APART}]]{DIGIT}]"
_REST = rf"[[\p{{L}}\p{{Nl}}&&[^{_APART}]]{DIGIT}{CONNECTOR}{EXTENDER}]"
# Plain letters are tried first, as the full classes are slow to test.
_PLAIN = r"a-z0-9\u00DF-\u00F6\u00F8-\u00FF"
_RUN = rf"[{_PLAIN}_]*+{_REST}*+"
_JOINT = (rf"(?=\S)(?:(?<=[[\p{{L}}&&[^{_APART}]]\p{{M}}]){INSIDE_WORD}(?={LETTER})"
          rf"|(?<={DIGIT}){INSIDE_NUMBER}(?={DIGIT}))")
_KATAKANA = rf"[{KATAKANA}][{KATAKANA}{EXTENDER}]*+"
# Only connectors join a run of Katakana with one of letters or digits.
_TAIL = rf"(?:{_JOINT}{_RUN}|(?=[^\x00-\x7F])(?<={CONNECTOR}){_KATAKANA}|(?={CONNECTOR}){_RUN})*+"
# A pictograph with its sign, tone or tags; joiners make several of them one.
_EMOJI = rf"[{PICTOGRAPH}{SKIN_TONE}](?:\uFE0F|[{SKIN_TONE}])?[{TAG}]*+"
_RARE = (rf"[{IDEOGRAPH}][{EXTENDER}]*+"
         rf"|{CONNECTOR}*+{_KATAKANA}{_TAIL}"
         rf"|(?:{UNSPACED}[{EXTENDER}]*+)++"
         rf"|{_EMOJI}(?:\u200D{_EMOJI})*+[{EXTENDER}]*+"
         rf"|[{FLAG_LETTER}]{{2}}[{EXTENDER}]*+")
# Possessive repeats: nothing to backtrack into, and no stack growth on very long words.
# Nor can other characters begin a word, or any follow plain letters before a blank: none of the classes is tested there.
_BEGIN = r"(?=[A-Za-z0-9_#*]|[^\x00-\x7F])"
_END = r"(?=[.,;:]?+[ \n]|[!?()])"
WORD = (rf"{_BEGIN}(?:[{_PLAIN}]++(?:{_END}|{_RUN}{_TAIL})|(?:{_START}|{CONNECTOR}++{_START}){_RUN}{_TAIL}"
        rf"|(?=[^\x00-\x7F])(?:{_RARE})|{CONNECTOR}++{_KATAKANA}{_TAIL}|[#*]{KEYCAP})")
_PIECE = rf"(?s).{{1,{MAX_WORD}}}"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _pieces(word: Column) -> Column:
    return F.flatten(F.transform(F.regexp_extract_all(word, F.lit(_PIECE), F.lit(0)), _words))


def tokens(text: Column | str) -> Column:
    """Lower-cased words of ``text`` in order; no stop words, no stemming."""
    lowered = F.lower(F.col(text) if isinstance(text, str) else text)
    return F.flatten(F.transform(
        _words(lowered),
        lambda w: F.when(F.length(w) <= MAX_WORD, F.array(w)).otherwise(_pieces(w))))


def quantised_length(length: Column) -> Column:
    """A document length as one byte keeps it: exact below 40, then four leading bits above 24."""
    over = length - 24
    shift = F.length(F.bin(over)) - 4
    coarse = 24 + F.call_function("shiftleft", F.call_function("shiftright", over, shift), shift)
    return F.when(length < 40, length).otherwise(coarse).cast("int")
