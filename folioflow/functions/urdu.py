"""Urdu in Latin letters, for addresses of pages."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Latin letters with those they stand for. Vowels are set off: no other vowel goes beside them.
_CONSONANTS = "b:ب ch:چ d:دڈ f:ف g:گ gh:غ h:حہۃھۂ j:ج k:ک kh:خ l:ل m:م n:نں p:پ q:ق r:رڑ s:ثسص sh:ش t:تٹط z:ذزضظ zh:ژ"
_VOWELS = "aa:آ a:اأَ e:ےۓ i:یئِ o:وؤ u:ُ"
_SOUNDS = {c: (latin, vowel) for table, vowel in ((_CONSONANTS, False), (_VOWELS, True)) for latin, _, letters in (x.partition(":") for x in table.split()) for c in letters}
#: At the beginning of a word these are consonants.
_GLIDES = {"ی": "y", "ئ": "y", "و": "w"}
#: Words whose usual spelling doesn't follow from their letters.
_USUAL = dict(
    reversed(pair.split("="))
    for pair in """aasman=آسمان aasman=آسماں ahmad=احمد ak=اک aur=اور bagh=باغ bazm=بزم bhar=بھر bhi=بھی chiragh=چراغ dars=درس deewar=دیوار dil=دل do=دو ek=ایک gah=گاہ
    ghazal=غزل hai=ہے hain=ہیں halat=حالت har=ہر hayat=حیات ho=ہو hun=ہوں hussain=حسین is=اس ishq=عشق jahan=جہاں jis=جس jo=جو ka=کا kabhi=کبھی kahani=کہانی kaun=کون ke=کے keh=کہ
    khwab=خواب khwabon=خوابوں ki=کی kisi=کسی kise=کسے kitab=کتاب kitaben=کتابیں ko=کو koi=کوئی kuch=کچھ kya=کیا lehar=لہر mein=میں mera=میرا mere=میرے meri=میری mira=مرا
    muhammad=محمد na=نہ nahin=نہیں nazm=نظم ne=نے nigah=نگاہ pani=پانی par=پر phir=پھر pul=پل qadam=قدم raat=رات roz=روز sabz=سبز saeed=سعید saya=سایہ se=سے shajar=شجر
    shaoor=شعور to=تو us=اُس wo=وہ ye=یہ zamin=زمیں zamin=زمین""".split()
)
_OTHER = re.compile(r"[^؀-ۿA-Za-z0-9\s]")
_LATIN = re.compile(r"[A-Za-z0-9]+")


def in_latin(word: str) -> str:
    """A word in Latin letters. A short a goes after a consonant that another one follows: the first of a word always,
    a later one unless a vowel comes after the next."""
    if usual := _USUAL.get(word):
        return usual
    if _LATIN.fullmatch(word):
        return word.lower()
    sounds: list[tuple[str, bool]] = []
    for c in word:
        if not sounds and c in _GLIDES:
            sounds.append((_GLIDES[c], False))
        elif c in _SOUNDS:
            sounds.append(_SOUNDS[c])
    out = ""
    for n, (latin, vowel) in enumerate(sounds):
        out += latin
        follows = sounds[n + 1 : n + 3]
        if not vowel and follows and not follows[0][1] and (n == 0 or len(follows) < 2 or not follows[1][1]):
            out += "a"
    return out


def slugify(title: str) -> str:
    """The words in Latin letters, with hyphens between."""
    plain = _OTHER.sub(" ", title.replace("ـ", ""))
    return re.sub("-+", "-", "-".join(filter(None, map(in_latin, plain.split())))).strip("-").lower()


@F.pandas_udf(T.StringType())
def slugified(titles):
    return titles.map(lambda t: None if t is None else slugify(t))
