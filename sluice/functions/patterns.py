"""Text patterns, written once for Java regexes.

Word edges are spelled as look-arounds over Unicode letters, numbers and underscore rather
than ``\\b``, whose meaning changes between Java releases. Case folding is spelled out where
Unicode has extra partners that are wanted (long s, dotless and dotted i, Kelvin sign).
"""

WORD = r"[\p{L}\p{N}_]"
EDGE_L = rf"(?<!{WORD})"
EDGE_R = rf"(?!{WORD})"
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# A look-ahead for the first character comes first, so that most positions fail on one class test.
SSN_CORE = r"\p{Nd}{3}-\p{Nd}{2}-\p{Nd}{4}"
SSN = rf"(?=\p{{Nd}}){EDGE_L}({SSN_CORE}){EDGE_R}"
SSN_LOOSE = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"

ROUTING_LOWER = r"routing (?:number )?(\p{Nd}{9})"
NINE_DIGITS = rf"(?=\p{{Nd}}){EDGE_L}\p{{Nd}}{{9}}{EDGE_R}"

PASSPORT_WORD = "[Pp][Aa][Ss\u017f][Ss\u017f][Pp][Oo][Rr][Tt]"
PASSPORT_CHAR = "[A-Za-z0-9\u0130\u0131\u017f\u212a]"
PASSPORT = rf"{PASSPORT_WORD}[^\n]*?{EDGE_L}({PASSPORT_CHAR}{{6,10}}){EDGE_R}"

MRN_LOWER = rf"{EDGE_L}mrn{EDGE_R}"
MRN_SPACED = rf"(?=[Mm]){EDGE_L}(?i:mrn){SPACE}*\p{{Nd}}+{EDGE_R}"
MRN_PUNCT = rf"(?=[Mm]){EDGE_L}(?i:mrn)(?::|{SPACE})*\p{{Nd}}+{EDGE_R}"

PHI_LOWER = (
    rf"{EDGE_L}(?:patient|diagnosis|diagnosed|medication|strep|test(?:ed)? positive){EDGE_R}"
)
# Every PHI phrase contains one of these, so a plain substring test can rule most texts out.
PHI_STEMS = ["patient", "diagnos", "medication", "strep", " positive"]

ADDRESS = (
    rf"(?=\p{{Nd}}){EDGE_L}\p{{Nd}}+{SPACE}+{WORD}+{SPACE}+"
    "(?:(?i:blvd|ave|rd|dr)|[Ss\u017f][Tt]|[Dd][Rr][Ii\u0130\u0131][Vv][Ee])"
    rf"{EDGE_R}"
)

# What masking cuts out: (type, pattern whose group is the value at its end, substring the lower-cased text must hold).
# A passport is masked as it is detected, the first token of six to ten characters, and as it is written, the
# first token with a digit.
MRN_GAP = SPACE.replace("[", "[:", 1)
SPANS = [
    ("SSN", rf"(?=\p{{Nd}}){EDGE_L}({SSN_CORE}){EDGE_R}", "-"),
    ("ROUTING", r"(?=[Rr])(?i:routing (?:number )?)(\p{Nd}{9})", "routing "),
    ("PASSPORT", PASSPORT, "port"),
    ("PASSPORT", rf"{PASSPORT_WORD}[^\n]*?[^\p{{L}}\p{{N}}_\n]([A-Za-z]*[0-9][A-Za-z0-9]*)", "port"),
    ("MRN", rf"(?=[Mm]){EDGE_L}(?i:mrn){MRN_GAP}*(\p{{Nd}}+)", "mrn"),
]
# The detectors that no rule uses: street addresses and bare words of nine digits.
SPARE_SPANS = [("ADDRESS", f"({ADDRESS})", " "), ("ROUTING", f"({NINE_DIGITS})", "")]
