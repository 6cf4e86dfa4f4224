"""The eight-bit code of the older book files."""

from __future__ import annotations

_LETTERS = "ابپتٹثجچحخدڈذرڑزژسشصضطظعغفقکگلمن"
_SIGNS = {0x20: " ", 0xA1: "ں", 0xA2: "و", 0xA3: "ئ", 0xA4: "ی", 0xA5: "ے", 0xA6: "ہ", 0xA7: "ھ"}
#: Marks are written after the letter that has them.
_MARKS = {0xAA: 0x650, 0xAB: 0x64E, 0xAC: 0x64F, 0xAD: 0x651, 0xB3: 0x653, 0xBD: 0x670, 0xBF: 0x654, 0xC7: 0x64B, 0xC8: 0x622, 0xCF: 0x614}
_STOPS = {0xDA: "!", 0xDF: "-", 0xE1: ")", 0xE2: "(", 0xE9: ":", 0xED: "،", 0xEE: "؟", 0xF3: "۔", 0xFD: "’", 0xFE: "‘"}
CODES: dict[int, str] = _SIGNS | {0x81 + n: c for n, c in enumerate(_LETTERS)} | {k: chr(v) for k, v in _MARKS.items()} | {0xD0 + n: chr(0x6F0 + n) for n in range(10)} | _STOPS
BACK: dict[str, int] = {c: k for k, c in CODES.items()}
