"""Candidates for personal data in a text, with the votes of weak labelers.

Every labeler looks at one candidate and votes for it (+), against it (-) or abstains (0). Their votes are put together
in `private`; none of them decides alone. Positions are code points from 0.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from functools import lru_cache
from typing import NamedTuple

UPPER = "".join(c for c in map(chr, range(0x590)) if unicodedata.category(c) == "Lu")
LOWER = "".join(c for c in map(chr, range(0x590)) if unicodedata.category(c) == "Ll")
U, L = re.escape(UPPER), re.escape(LOWER)
GAP = r"[ \u00a0\u2007\u2009\u202f]"

#: What stands before or after mentions in English, French and Spanish.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Mme", "Mlle", "Sr", "Sra", "Srta", "Dra", "Sir", "Lady", "Messrs")
OFFICES = ("Governor", "Minister", "Gouverneur", "Ministre", "Gobernador", "Gobernadora", "Ministro", "Ministra", "President", "Ambassador", "Secretary", "Madame", "Monsieur", "Señor", "Señora")
PARTICLES = ("van der", "van den", "van de", "van", "von", "de la", "de las", "de los", "del", "de", "da", "dos", "du", "di", "le", "la", "bin", "ibn", "el", "al", "ter", "ten", "st")
STREETS = ("Road", "Rd", "Street", "St", "Avenue", "Ave", "Lane", "Ln", "Boulevard", "Blvd", "Square", "Sq", "Drive", "Dr", "Way", "Court", "Ct", "Terrace", "Place", "Pl", "Row", "Quay", "Close", "Crescent", "Hill", "Parade", "Walk", "Highway", "Hwy")
ROADS = ("rue", "avenue", "boulevard", "place", "chemin", "quai", "allée", "impasse", "calle", "avenida", "av.", "plaza", "paseo", "carrera", "camino", "via", "viale", "rua")
ID_WORDS = r"passport|passeport|pasaporte|national\s+id\w*|nationality\s+id|identity|identité|identidad|\bid\b|tax\s+file|taxpayer|\btax\s+(?:id|no|number)|\btin\b|\bnif\b|\bnit\b|\bdni\b|\bssn\b|\bsin\b|\bnino\b|social\s+(?:security|insurance)|national\s+insurance|insurance\s+n|c[ée]dula|fiscal\s+n|num[ée]ro\s+fiscal|licen[cs]e\s+n"
PHONE_WORDS = r"\b(?:tel|phone|telephone|mobile|cell|fax|call|tél|téléphone|teléfono|tfno|móvil|hotline|dial|ring)\b\.?"
#: What numbers in documents and accounts stand behind, in the three languages.
NUMBERED = r"tables?|figures?|box|loan|project|decision|report|series|annex|article|page|paragraph|tableau|graphique|annexe|rapport|cuadro|gráfico|anexo|informe|préstamo|prêt"
NOT_PHONE = rf"(?:\b(?:{NUMBERED})|sdr|us\$|\$|€|\bno\.)\W{{0,3}}$"
BEFORE_NAME = ("by", "contact", "contact :", "contact:", "contacts:", "contacts :", "contacto:", "to", "with", "according", "name:", "name :", "sincerely,", "regards,", "from", "de", "del", "par", "ante", "attn", "attn:", "and", "et", "y")
BEFORE_STRONG = ("prepared by", "statement by", "filed by", "signed by", "approved by", "according to", "contact", "contact:", "contact :", "contacto", "contacto:", "contacto :", "name:", "name :", "sincerely,", "regards,", "met with", "déclaration de", "declaración de", "declaración del")
AFTER_NAME = r"^(?:\s*,?\s*(?:joined|concluded|agreed|noted|underscored|said|stated|considered|emphasi[sz]ed|acknowledged|observed|argued|pointed|stressed|recalled|cautioned|reiterated|maintained|recogni[sz]ed|welcomed|tel\b|tél\b|at\s+\S+\s?[@\[(]|passport|national\s+id|tin\b|ssn\b|tax\s+file|social|identity)|\s*,\s*(?:[0-9]{2}|[A-Z][\w’]+\s+(?:director|advisor|administrator)|executive|alternate|senior|administrateur|director|\S+\s+\S+,\s+and)|\s+\(all\s+[\w-]+\)|\s*[\r\n]+\s*(?:governor|minister|gobernador|gouverneur)|\s+and\s+[A-Z][\w’-]+\s+[A-Z])"
#: Nouns of offices, bodies, documents and places, which stand in capitals without being persons.
INSTITUTIONS = frozenset(
    "executive director senior advisor deputy governor minister president secretary chairman mission authorities delegation"
    " central bank ministry finance treasury board fund council committee commission department government parliament agency authority office bureau institute university corporation company group"
    " republic kingdom federation union commonwealth principality islands upper lower north south east west saint"
    " staff report press release article consultation annex framework agreement statement appendix act law code policy program programme monetary fiscal statistics"
    " road street avenue boulevard square lane drive terrace quay crescent highway the".split()
)

EMAIL = re.compile(r"[\w.+%'’-]*\w ?@ ?\w[\w-]*(?:\s?\.\s?\w[\w-]*)*\.[^\W\d_]{2,}", re.U)
EMAIL_SPELLED = re.compile(r"(?i)\w[\w.+%-]*\s*[\[({<]\s*(?:at|arobase|arroba|@)\s*[\])}>]\s*\w[\w-]*(?:(?:\s*[\[({<]\s*(?:dot|point|punto|\.)\s*[\])}>]\s*|\.)\w[\w-]*)+")
EMAIL_AT = re.compile(r"[\[({<]\s*(?:at|arobase|arroba|@)")
EMAIL_WORDS = re.compile(r"\b\w[\w.+%-]* (?:AT|at) \w[\w-]*(?: (?:DOT|dot) \w[\w-]*)+")
#: Patterns begin with one class of characters and look back behind it, so that a search passes over the rest of a text quickly.
GAP_IN_PHONE = "[-. \u00a0\u202f]"
PHONE = re.compile(
    rf"[+(0-9](?<![\w.,/+-].)(?:"
    rf"(?<=\+) ?[0-9]{{1,3}}{GAP_IN_PHONE}?(?:\([0-9]{{1,4}}\){GAP_IN_PHONE}?)?[0-9]{{1,4}}(?:{GAP_IN_PHONE}?[0-9]{{2,4}}){{1,4}}"
    rf"|(?<=0)0[0-9]{{2,3}}(?:{GAP_IN_PHONE}?[0-9]{{2,4}}){{2,5}}"
    rf"|(?<=\()[0-9]{{2,4}}\){GAP_IN_PHONE}?[0-9]{{3,4}}{GAP_IN_PHONE}[0-9]{{3,4}}"
    rf"|(?<=[0-9])[0-9]{{2}}{GAP_IN_PHONE}[0-9]{{3}}{GAP_IN_PHONE}[0-9]{{4}}"
    rf"|(?<=0)[0-9]{{2,4}}(?:{GAP_IN_PHONE}[0-9]{{2,4}}){{2,4}}"
    rf"|(?<=[0-9])[0-9]{{2}}(?: [0-9]{{3}}){{2,3}}"
    r")(?![0-9]|[-.,/][0-9])"
)
PHONE_BEFORE, NO_PHONE = re.compile(PHONE_WORDS + r"[^\n;]{0,30}$", re.I), re.compile(NOT_PHONE, re.I)
IDENTITY_FORMS = (
    r"[A-Z]{1,2}[0-9]{6,9}[A-Z]?|[0-9]{6}-[0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{2}-[0-9]{7}|[0-9]{3} [0-9]{3} [0-9]{3}"
    r"|[A-Z]{2} ?[0-9]{2} ?[0-9]{2} ?[0-9]{2} ?[A-Z]|[A-Z]{2,3}-[0-9]{3,6}-[0-9]{2,6}|[A-Z][0-9]{1,3}-[0-9]{2,4}|[0-9]{7,9}-[0-9A-Z]|[0-9]{3}-[0-9]{3}/[A-Z]"
)
IDENTITY_ANY = r"[A-Z]{0,3}-?[0-9][0-9A-Z]{4,13}(?:[ -][0-9A-Z]{1,6}){0,3}"
IDENTITY_START = re.compile(r"[A-Z0-9](?<![\w/+.-].)(?:(?<=[0-9])|(?<=[A-Z])(?=[A-Z]{0,2}[- ]?[0-9]))")
IDENTITY = re.compile(rf"(?:{IDENTITY_FORMS}|{IDENTITY_ANY})(?![\w/]|-[0-9])")
IDENTITY_FORM = re.compile(r"[A-Z][0-9]{7}|[0-9]{6}-[0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{2}-[0-9]{7}|[A-Z]{2} [0-9]{2} [0-9]{2} [0-9]{2} [A-Z]|[A-Z]{2}-[0-9]{4}-[0-9]{3}|[0-9]{8}-[0-9]")
NOT_IDENTITY_FORM = re.compile(r"[A-Z][0-9]{1,3}-[0-9]{2,4}|[0-9]{3}-[0-9]{3}/[A-Z]|[0-9]{1,7}")
IDENTITY_BEFORE = re.compile(rf"(?i)(?:{ID_WORDS})[^\n;]{{0,14}}$")
NOT_IDENTITY = re.compile(rf"(?i)(?:\b(?:{NUMBERED})|no\. [0-9]+/|[0-9;.] )\W{{0,2}}$")
CAP = rf"[{U}][\w’'-]*"
KW = rf"(?:{'|'.join(STREETS)}|{'|'.join(w.upper() for w in STREETS)})\b\.?"
ROAD = "(?:" + "|".join(sorted({re.escape(v) for w in ROADS for v in (w, w.capitalize(), w.upper())}, key=len, reverse=True)) + ")"
ROAD_NAME = rf"{GAP}+(?:(?i:des|de{GAP}la|de{GAP}los|de{GAP}las|du|del|de|d[’']|l[’']){GAP}*)*{CAP}(?:{GAP}+{CAP}){{0,2}}"
HOUSE = re.compile(r"[0-9](?<![\w.,/+-].)[0-9]{0,4}(?:[a-zA-Z]\b|/[0-9]{1,3}\b|-[0-9]{1,4}\b)?(?![\w%]|[.,][0-9])")
STREET_AFTER = re.compile(rf",?{GAP}+(?:(?:{CAP}{GAP}+){{1,4}}?{KW}|(?:(?:bis|ter),?{GAP}+)?{ROAD}{ROAD_NAME})")
STREET_BEFORE = re.compile(rf"(?:(?:{CAP}{GAP}+){{1,4}}?{KW}|{ROAD}{ROAD_NAME}),?{GAP}+(?:(?:No|Nr|N[º°]|n[.º°o]+)\.?{GAP}*)?$")
CAP_BEFORE = re.compile(rf"{CAP}\.?,?{GAP}+(?:(?:No|Nr|N[º°]|n[.º°o]+)\.?{GAP}*)?$")
NO_BEFORE = re.compile(rf"\b(?:No|Nr|N[º°])\.?{GAP}*$")
ADDRESS_BEFORE = re.compile(r"(?i)(?:\bof|\bto|\bat|\bau|\ben|\bqueda en|\btrouve au|\bsent to|[\r\n])\s*$")
ADDRESS_AFTER = re.compile(rf"(?:,?\s+[0-9]{{4,6}}\b|,\s*Flat|[,\r\n]\s*[{U}][{L}]+|\.)")
#: A street that goes on in a noun without an article names something else: function words and forms of verbs may follow an address.
NOT_ADDRESS = re.compile(rf"{GAP}+(?!(?:and|or|in|at|on|by|to|of|for|from|near|with|is|was|were|are|which|where|et|ou|à|au|en|dans|près|est|y|o|de|del|du|a|cerca|es|que|qui)\b)[{L}]+(?<!ed)(?<!ing)\b")
TOWN = rf"{CAP}(?:{GAP}+(?:(?:de|del|la|le|les|of|the|sur|on){GAP}+)*{CAP}){{0,3}}"
ADDRESS_REST = re.compile(rf"(?:,?{GAP}+(?:Flat|Apt|Apartment|Suite|Floor|Unit|Room|Apto|Piso|Bureau|bte|BP|P\.?O\.?{GAP}+Box)\.?{GAP}+[\w-]+|,{GAP}*[0-9]{{4,6}}(?:{GAP}+{TOWN})?(?![\w@])|,{GAP}*{TOWN}(?:{GAP}+[0-9]{{4,6}})?(?![\w@’'])|{GAP}+[0-9]{{5}}(?:{GAP}+{TOWN})?(?![\w@]))")

WORD = rf"(?:[{U}](?:[{L}]+|[{U}]+)(?:[’'-][{U}{L}]+)*|[{U}][’'][{U}][{U}{L}]+)"
PART = rf"(?:(?:(?i:{'|'.join(PARTICLES)}){GAP}+|(?i:al|el|ben)-|[OD][’'](?=[{U}]))*)"
FAMILY = rf"{PART}[{U}][{U}{L}’']+(?:-{PART}[{U}][{U}{L}’']+)?"
INITIALS = rf"(?:[{U}]\.(?:{GAP}?-?[{U}]\.)*)"
FULL = re.compile(rf"(?P<given>[{U}](?<![\w’'.@-].)(?:[{L}]+(?:-[{U}][{L}]+)?|[{U}]+(?:-[{U}]{{2,}})?))(?:{GAP}+(?P<middle>{INITIALS}))?{GAP}+(?P<family>{FAMILY})(?![\w@])")
INITIAL = re.compile(rf"(?P<given>[{U}](?<![\w’'.@-].)\.(?:{GAP}?-?[{U}]\.)*){GAP}*(?P<family>{FAMILY})(?![\w@])")
#: Words between capitals that go on behind a name in a heading.
FUNCTION_WORDS = "ON|OF|AND|THE|TO|FOR|IN|AT|BY|FROM|WITH|AU|AUX|EN|DE|DU|DES|SUR|POUR|PAR|ET|Y|EXECUTIVE|ALTERNATE|DIRECTOR|GOVERNOR|MINISTER"
TITLE_STARTS = "".join(sorted({t[0] for t in (*TITLES, *OFFICES)}))
TITLED = re.compile(rf"[{TITLE_STARTS}](?<!\w.)(?P<title>(?:{'|'.join(rf'(?<={t[0]}){t[1:]}' for t in (*TITLES, *dict.fromkeys(t.upper() for t in TITLES)))})\b\.?[ \r\n]{{1,2}}|(?:{'|'.join(rf'(?<={t[0]}){t[1:]}' for t in OFFICES)}){GAP}+)(?P<name>(?:(?:[{U}][{L}]+|[{U}]{{2,}}(?={GAP}+(?:{INITIALS}{GAP}+)?[{U}]{{2,}}\b)(?!{GAP}+(?:{FUNCTION_WORDS})\b)|{INITIALS}){GAP}+(?:{INITIALS}{GAP}+)?)?(?P<family>{FAMILY}))(?![\w@])")
REVERSED = re.compile(rf"(?<![\w’'.@-])(?P<family>{FAMILY}),{GAP}+(?P<given>[{U}][{L}]+|[{U}]{{2,}}\b)(?:{GAP}+{INITIALS})?")
BEHIND = re.compile(AFTER_NAME, re.I)
NAMED = re.compile(r"[Nn](?<!\w.)(?:ame|om|ombre|(?<=N)(?:AME|OM|OMBRE))\s?:\s*")
GIVEN_BEFORE = re.compile(rf"([{U}][{U}{L}’'-]+){GAP}+$")
#: Words that are no part of a name, also where they are capitalized.
NOT_NAMES = frozenset("by mr mrs ms dr prof messrs of on behalf the and to in at for from with under some yours sincerely statement prepared approved contact name tel fax phone mobile cc governor minister senior executive advisor director table figure box loan decision"
    " a an both either neither each every all any no not when while whereas after before although though since once if as that this these those there here then thus hence but or nor so yet because until unless also however"
    " le la les un une des du de et ou mais donc car quand lorsque si comme selon pour dans sur avec sans el los las una unos y o pero cuando aunque como según para con sin en".split())
MONTH_NAMES = frozenset("january february march april may june july august september october november december monday tuesday wednesday thursday friday saturday sunday".split())
MORE_NAME = re.compile(rf"{GAP}+(?P<word>{PART}[{U}][{U}{L}’']+(?:-[{U}][{U}{L}’']+)?)(?![\w@’'])")
SENTENCE_START = re.compile(r"(?:^|[.!?:;)\n][\"'”’)]*)\s*$")
#: Honorifics behind a name in Chinese and Japanese.
HAN = re.compile(r"[\u4e00-\u9fff]{2,4}(?=\u5148\u751f|\u5973\u58eb|\u5c0f\u59d0|\u535a\u58eb|\u6559\u6388|\u90e8\u957f|\u884c\u957f|\u3055\u3093|\u6c0f(?!\w))")
FRENCH_M = re.compile(r"(?i)(?:\b(?:de|par|à|et|avec|que|selon|pour|chez|le)|\bd[’'])\s+$")
FRENCH_M_AHEAD = re.compile(r"(?i),?\s+(?:administrateur|ministre|gouverneur|a\s+(?:noté|souligné|indiqué|déclaré|estimé|rappelé))")


class Candidate(NamedTuple):
    kind: str
    begin: int
    end: int
    votes: str
    given: str
    family: str
    stop: int = 0  # where the mention ends for a reader: further names, flat and town belong to it; end if 0


LABELERS = {"email": 4, "phone": 5, "identity": 4, "address": 4, "name": 8}


def _vote(*signs: int) -> str:
    return "".join("-0+"[s + 1] for s in signs)


@lru_cache(200_000)
def _institution(word: str) -> bool:
    return any(w in INSTITUTIONS for w in word.casefold().split())


def _led(before: str, leads: tuple[str, ...]) -> bool:
    """Whether before, which begins with a blank, ends in one of the leads, and the lead begins a word."""
    return before.endswith(leads) and any(before.endswith(x) and not ((c := before[-len(x) - 1]).isalnum() or c == "_") for x in leads)


def emails(t: str) -> list[Candidate]:
    out = []
    if "@" in t:
        for m in EMAIL.finditer(t):
            begin, s = m.start(), m[0]
            tld = s.rpartition(".")[2]
            out.append(Candidate("email", begin, m.end(), _vote(1 if " " not in s else 0, 1 if tld.isalpha() else -1, 1 if re.search(r"(?i)(?:mail\w*|correo|courriel|cc|reached|at|<|;)\W*$", t[max(0, begin - 14) : begin]) else 0, -1 if s[0].isdigit() and " " in s else 0), "", ""))
    low = t.casefold()
    if EMAIL_AT.search(low):
        out += [Candidate("email", m.start(), m.end(), _vote(1, 1 if re.search(r"(?i)[\[({<]\s*(?:dot|point|punto|\.)", m[0]) else 0, 1 if re.search(r"(?i)(?:mail\w*|correo|courriel|cc|reached|at|<|;)\W*$", t[max(0, m.start() - 14) : m.start()]) else 0, 0), "", "") for m in EMAIL_SPELLED.finditer(t)]
    if " dot " in low:
        out += [Candidate("email", m.start(), m.end(), _vote(0, 1, 0, 0), "", "") for m in EMAIL_WORDS.finditer(t)]
    return out


def phones(t: str) -> list[Candidate]:
    out = []
    for m in PHONE.finditer(t):
        s, before, after = m[0], t[max(0, m.start() - 40) : m.start()], t[m.end() : m.end() + 12]
        digits = sum(c.isdigit() for c in s)
        international = s[0] == "+" or s.startswith("00")
        plain = re.fullmatch(r"[0-9]{3}(?: [0-9]{3})+", s) is not None
        begin = m.start() + (s[0] == "(")
        out.append(Candidate("phone", begin, m.end(), _vote(
            1 if international or s[0] == "(" else 1 if re.fullmatch(r"0[0-9]{2,4}(?: [0-9]{2})+|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}", s) else -1 if plain else 0,
            1 if PHONE_BEFORE.search(before) else 0,
            -1 if NO_PHONE.search(before) or IDENTITY_BEFORE.search(before) else 0,
            1 if 8 <= digits <= 15 else -1,
            1 if re.match(r",?\s*(?:x|ext\.?)\s?[0-9]|\s*/\s*[+0(]", after) or re.search(r"(?:/\s*|\b(?:or|at)\s+|\n\s*)$", before) else -1 if re.match(r"\s*(?:percent|%|a year)|[/][A-Z]", after) else 0,
        ), "", ""))
    return out


def identities(t: str) -> list[Candidate]:
    out: list[Candidate] = []
    for start in IDENTITY_START.finditer(t):
        m = IDENTITY.match(t, start.start())
        if not m or (out and m.start() < out[-1].end):
            continue
        begin, end, s, before = m.start(), m.end(), m[0], t[max(0, m.start() - 34) : m.start()]
        known, form = IDENTITY_BEFORE.search(before) is not None, IDENTITY_FORM.fullmatch(s) is not None
        if known or form or re.fullmatch(IDENTITY_FORMS, s):
            out.append(Candidate("identity", begin, end, _vote(
                1 if known else 0,
                1 if form else -1 if NOT_IDENTITY_FORM.fullmatch(s) else 0,
                -1 if not known and NOT_IDENTITY.search(before) else 0,
                1 if re.match(r"\s*(?:;|,\s+of\b|twice|del\b|,)", t[end : end + 8]) else 0,
            ), "", ""))
    return out


def addresses(t: str) -> list[Candidate]:
    """A street with a house number before or behind it; every search begins at a number."""
    out: list[Candidate] = []
    last = -1
    for m in HOUSE.finditer(t):
        if m.start() < last:
            continue
        if x := STREET_AFTER.match(t, m.end()):
            begin, end = m.start(), x.end()
            if y := NO_BEFORE.search(t[max(0, begin - 5) : begin]):
                begin -= len(y[0])
            order = 1
        elif CAP_BEFORE.search(t[max(0, m.start() - 26) : m.start()]) and (y := STREET_BEFORE.search(head := t[max(last, 0, m.start() - 70) : m.start()])):
            begin, end, order = m.start() - len(head) + y.start(), m.end(), 0
        else:
            continue
        last, stop = end, end
        while more := ADDRESS_REST.match(t, stop):
            stop = more.end()
        out.append(Candidate("address", begin, end, _vote(
            order,
            1 if ADDRESS_BEFORE.search(t[max(0, begin - 14) : begin]) else 0,
            1 if ADDRESS_AFTER.match(t[end : end + 24]) else 0,
            -1 if NOT_ADDRESS.match(t, end) else 0,
        ), "", "", stop))
    return out


def _name_stop(t: str, c: Candidate, limit: int) -> int:
    """The end of a name with the further words that belong to it: capitalized as it is, and neither institutions nor months, up to the next mention."""
    core, stop = t[c.begin : c.end], c.end
    while m := MORE_NAME.match(t, stop, limit):
        word = m["word"].split()[-1]
        low = word.casefold().rstrip("’'")
        if word.isupper() != core.isupper() or low in NOT_NAMES or low in MONTH_NAMES or _institution(low):
            break
        stop = m.end()
    return stop


def names(t: str, given_names: frozenset[str]) -> list[Candidate]:
    found: dict[int, Candidate] = {}
    begins: list[int] = []  # of the accepted spans, in order; no two of them overlap
    ends: list[int] = []

    def add(begin: int, end: int, given: str, family: str, form: str, head: int | None = None, held: bool = True) -> None:
        behind = begin if head is None else head  # a title belongs to the mention's surroundings
        before, after = " " + " ".join(t[max(0, behind - 30) : behind].casefold().split()), t[end : end + 40]
        g = given.casefold().strip(" .")
        words = f"{given} {family}"
        found[begin] = Candidate("name", begin, end, _vote(
            1 if g in given_names or any(x in given_names for x in g.split("-")) else 0,
            1 if form == "titled" else 0,
            1 if _led(before, BEFORE_STRONG) else 0,
            1 if _led(before, BEFORE_NAME) or before.endswith(",") else 0,
            1 if BEHIND.match(after) else 0,
            1 if form in ("initial", "middle", "titled") else 0,
            -1 if _institution(words) else 0,
            1 if form == "reversed" else -1 if after[:1] == ":" else 0,
        ), given, family)
        if held and (form != "plain" and form != "middle" or not _institution(words)):  # 'Governor Prepared By': the next pair may begin inside
            i = bisect_left(begins, begin)
            begins.insert(i, begin)
            ends.insert(i, end)

    def word(x: str) -> bool:
        return x.casefold().rstrip(".") in NOT_NAMES

    def free(begin: int, end: int) -> bool:
        i = bisect_left(begins, end)
        return not i or ends[i - 1] <= begin

    for m in TITLED.finditer(t):
        given = t[m.start("name") : m.start("family")].strip()
        if given and m["family"].casefold() in MONTH_NAMES:  # 'Governor Varova March 2019'
            add(m.start("name"), m.start("name") + len(given), "", given, "titled", m.start())
        elif not word(m["family"].split()[-1]):
            add(m.start("name"), m.end("name"), given, m["family"], "titled", m.start())
    for lead in NAMED.finditer(t):
        if (m := REVERSED.match(t, lead.end())) and free(m.start(), m.end()):
            add(m.start(), m.end(), m["given"], m["family"], "reversed")
    for m in INITIAL.finditer(t):
        begin = m.start()
        if m["given"] == "M." and (FRENCH_M.search(t[max(0, begin - 8) : begin]) or FRENCH_M_AHEAD.match(t, m.end())):
            if free(m.start("family"), m.end()):
                add(m.start("family"), m.end(), "", m["family"], "titled")
        elif free(begin, m.end()) and not ((x := GIVEN_BEFORE.search(t[max(0, begin - 24) : begin])) and not word(x[1])):
            add(begin, m.end(), m["given"], m["family"], "initial")
    at = 0
    while m := FULL.search(t, at):
        at = m.end()
        if not free(m.start(), m.end()) or word(m["given"]) or word(m["family"].split()[-1]):
            at = m.start() + len(m["given"])
            continue
        form, given = "middle" if m["middle"] else "plain", m["given"].casefold()
        inner = form == "plain" and ' ' not in m["family"].strip() and given not in given_names and SENTENCE_START.search(t[max(0, m.start() - 4) : m.start()]) and FULL.match(t, m.start("family"))
        if inner and not word(inner["family"].split()[-1]):  # 'Earlier Jane Doe': the first word may only open a sentence, so both pairs are judged
            add(m.start(), m.end(), m["given"], m["family"], form, held=False)
            at = m.start("family")
            continue
        add(m.start(), m.end(), m["given"], m["family"], form)
        if _institution(f"{m['given']} {m['family']}"):
            at = m.start() + len(m["given"])
    for m in HAN.finditer(t):
        add(m.start(), m.end(), m[0][1:], m[0][:1], "titled")
    order = sorted(found.values(), key=lambda c: c.begin)
    return [c._replace(stop=_name_stop(t, c, d.begin if d else len(t))) for c, d in zip(order, [*order[1:], None])]


def candidates(t: str | None, given_names: frozenset[str]) -> list[Candidate]:
    """All candidates of a text. Where kinds overlap, an email stands before the rest, a named identity number before a phone number, and both and an address before a name."""
    if not t:
        return []
    mails = emails(t)
    taken = [(c.begin, c.end) for c in mails]
    clear = lambda c: not any(a < c.end and c.begin < b for a, b in taken)
    out = mails
    ids, tel, adr = ([], [], []) if not any(map(str.isdigit, t)) else (identities(t), phones(t), addresses(t))
    for group in ([c for c in ids if c.votes[0] == "+"], [c for c in tel if c.votes[0] == "+"], [c for c in ids if c.votes[0] != "+"], [c for c in tel if c.votes[0] != "+"], adr, names(t, given_names)):
        own = [c for c in group if clear(c)]
        out = out + own
        taken += [(c.begin, c.end) for c in own if c.kind != "address" or c.votes[0] == "+"]
    return out


@lru_cache(100_000)
def shape(s: str) -> str:
    return RUNS.sub(r"\1", "".join("A" if c in UPPER_SET else "a" if c.isalpha() else "9" if c.isdigit() else " " if c.isspace() else c for c in s))[:16]


RUNS, TOKENS, UPPER_SET = re.compile(r"(.)\1+"), re.compile(r"\w+|[^\w\s]"), frozenset(UPPER)


@lru_cache(100_000)
def _neighbour(word: str) -> str:
    return shape(word) if word.isdigit() else word.casefold()


def features(t: str, c: Candidate) -> list[str]:
    """What the final classifier sees: form, affixes and neighbouring words, next to the votes."""
    before = TOKENS.findall(t[max(0, c.begin - 24) : c.begin])[-3:]
    after = TOKENS.findall(t[c.end : c.end + 24])[:3]
    f = ["b", "s:" + shape(t[c.begin : c.end]), *(f"v{i}{x}" for i, x in enumerate(c.votes) if x != "0"), *(f"l{i}:{_neighbour(w)}" for i, w in enumerate(reversed(before))), *(f"r{i}:{_neighbour(w)}" for i, w in enumerate(after))]
    if c.kind == "name":
        given, fam = c.given.casefold(), c.family.casefold()
        f += ["p:" + fam[:3], "q:" + fam[-3:], "Q:" + fam[-4:], "g:" + given[:3], "G:" + given[-3:]]
    return [f"{c.kind}|{x}" for x in f]
