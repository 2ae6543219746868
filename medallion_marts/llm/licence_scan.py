"""Licence scan by sentence rules.

A text is cut into sentences, these are normalised (words in lower case, no punctuation or
comment marks, one spelling of license) and mapped to the ids of known licence sentences; the
sequence of ids is matched against ordered licence rules, each of which takes its sentences out
of the sequence before the next is tried. What no rule takes is given as the rest: known sentences
that make up no licence, and sentences that speak of licences and are not known.

A known sentence begins and ends at a sentence's or a line's border, so one that is wrapped
over lines is found as well as one on a line of its own after text without a full stop. Only
sentences with one of the `STEMS` are looked at; no known sentence does without them.

Of long licences (GPL, LGPL, MPL, EPL, Apache) the notices and the title with its version are known,
not the sentences of their bodies; English only.

Defined results: null text counts as empty and has no licence; every row gives a row, repeated
ones and ones without id too; texts are scanned whole, however long; places are in characters of the
text; a licence whose version is not said has its name without one; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

STEMS = re.compile(r"licen[sc]|lizenz|gpl|copyright|©|permi(?:ssion|tted)|warrant|redistribut|liab|free\W+software|public\W+domain|\bcc0|\bcc\W+by|creative\W+commons|rights\W+reserved|endorse|advertising|this\W+product|this\W+notice|gnu\.org|(?:released|distributed|published|available|provided|offered|covered|shared)\W+(?:to\W+you\W+)?(?:under|with|by|using|according|subject)\b|spdx", re.I)
#: One of these is in each text that has a stem, and quicker to look for.
QUICK = ("licens", "licenc", "lizenz", "gpl", "copyright", "©", "permi", "warrant", "redistribut", "liab", "software", "domain", "cc", "creative", "reserved", "endorse", "advertising", "product", "notice", "gnu.org", "released", "distributed", "published", "available", "provided", "offered", "covered", "shared", "spdx")
#: A sentence with one of these that is not known is handed on as unknown.
STRONG = re.compile(r"\blicens|\b\w*lizenz|\b[al]?gpl|\bredistribut")
END = re.compile(
    r"(?:(?<!\b[a-z])(?<!\binc)(?<!\bltd)(?<!\bcorp)(?<!\bco)(?<!\bver)[.]|[!?]|(?<!licen[sc]e)(?<!identifier):)[\"'”’)\]*]*(?=\s|$)|[\n\r][\s*#/;%-]*[\n\r]|[\u2029]", re.I
)
WORD = re.compile(r"(?:[^\W_]+|©)(?:[.\-'’/+][^\W_]+)*\+?")
LINE = re.compile(r"[\n\r\v\f\x85\u2028|<>\t•]")

_V = r"(?:~?-?(?:version~|ver~|v~?)?(?P<v>\d+(?:\.\d+)*))?"
_CLAUSES = {"zero": "0", "two": "2", "three": "3", "four": "4", "simplified": "2", "freebsd": "2", "new": "3", "modified": "3", "revised": "3", "original": "4"}


def _gnu(g: dict) -> str:
    kind = g["kind"].replace("\n", " ")
    name = kind.upper() if kind.endswith("gpl") else {"l": "LGPL", "a": "AGPL"}.get(kind[0], "GPL")
    if not g["v"]:
        return name
    version = g["v"] if "." in g["v"] else g["v"] + ".0"
    return f"{name}-{version}-{'or-later' if g.get('later') else 'only'}"


def _bsd(g: dict) -> str:
    number = g["n"] or g["m"] or g["k"]
    return f"BSD-{_CLAUSES.get(number, number)}-Clause" if number else "BSD"


def _cc(g: dict) -> str:
    parts = re.split(r"[-~ \n/]+", g["parts"].replace("non-commercial", "nc").replace("share-alike", "sa").replace("no-derivatives", "nd"))
    short = {"attribution": "BY", "noncommercial": "NC", "sharealike": "SA", "noderivatives": "ND", "noderivs": "ND"}
    return "-".join(["CC", *(short.get(p, p.upper()) for p in parts), *([g["v"]] if g["v"] else [])])


def _plain(name: str, version: str | None = None) -> Callable[[dict], str]:
    """The name with the version said, two digits long, or with `version`."""

    def make(g: dict) -> str:
        v = g.get("v") or version
        return f"{name}-{v if '.' in v else v + '.0'}" if v else name

    return make


#: Licences by their names, ~ for a space or a line's end.
NAMES: list[tuple[str, Callable[[dict], str]]] = [
    (r"(?:gnu~)?(?P<kind>(?:(?:lesser|library|affero)~)?general~public~license|[al]?gpl)(?:~[al]?gpl)?" + _V + r"(?:~of~the~license)?(?P<later>\+|-or-later|~or~(?:at~your~option~)?(?:any~)?(?:later|newer)(?:~version)?)?(?:-only|~only)?", _gnu),
    (r"(?:gnu~free~documentation~license|gfdl)" + _V, _plain("GFDL")),
    (r"apache(?:~software)?(?:~?-?license)?" + _V, _plain("Apache")),
    (r"(?:mit/x11|mit|expat)(?:~license)?(?:~mit)?", _plain("MIT")),
    (r"x11(?:~license)?", _plain("X11")),
    (r"(?:(?P<n>[0234]|zero|two|three|four)[-~\n]clause~|(?P<k>simplified|new|modified|revised|original)~)?(?:free)?bsd(?:[-~](?P<m>[0234]|two|three|four)[-~]clause)?(?:-?style)?(?:~license)?", _bsd),
    (r"(?:creative~commons~|cc[-~])(?P<parts>(?:by|attribution)(?:[-~](?:nc|sa|nd|non-?commercial|share-?alike|no-?derivatives|no-?derivs))*)" + _V + r"(?:~international|~unported|~generic)?(?:~public)?(?:~license)?", _cc),
    (r"(?:(?:creative~commons~)?(?:cc0|zero))(?:[-~]?v?(?P<v>1\.0))?(?:~universal)?(?:~public~domain~dedication)?(?:~license)?", _plain("CC0", "1.0")),
    (r"(?:mozilla~public~license|mpl)(?:~mpl)?" + _V, _plain("MPL")),
    (r"(?:eclipse~public~license|epl)" + _V, _plain("EPL")),
    (r"(?:european~union~public~license|eupl)" + _V, _plain("EUPL")),
    (r"(?:common~development~and~distribution~license|cddl)" + _V, _plain("CDDL")),
    (r"(?:perl~)?artistic~license" + _V, _plain("Artistic")),
    (r"(?:boost~software~license|bsl)" + _V, _plain("BSL")),
    (r"(?:sil~)?(?:open~font~license|ofl)" + _V, _plain("OFL")),
    (r"(?:open~database~license|odbl)" + _V, _plain("ODbL")),
    (r"(?:microsoft~public~license|ms-pl)", _plain("MS-PL")),
    (r"(?:do~what~the~fuck~you~want~to~public~license|wtfpl)(?:~version~\d+)?", _plain("WTFPL")),
    (r"(?:python~software~foundation|psf)~license" + _V, _plain("PSF")),
    (r"isc(?:~license)?", _plain("ISC")),
    (r"zlib(?:/libpng)?(?:~license)?", _plain("Zlib")),
    (r"unlicense", _plain("Unlicense")),
]


def _compiled(pattern: str) -> str:
    # Within a class ~ is a space or a line's end as well.
    return re.sub(r"\[([^\]]*)~([^\]]*)\]", r"[\1 \\n\2]", pattern).replace("~", r"[ \n]")


def _bare(pattern: str) -> str:
    return re.sub(r"\(\?P<\w+>", "(?:", pattern)


_NAME = "(?:" + "|".join(_bare(p) for p, _ in NAMES) + ")"
_NAMED = f"(?P<names>{_NAME}(?:~license)?(?:~(?:or|and|and/or)~(?:the~)?{_NAME}(?:~license)?)*)"
_THING = r"(?:software|program|library|file|package|work|code|module|project|document|material)"
_VERB = r"(?:dual[-~])?(?:licensed|released|distributed|published|available|provided|offered|made~available|covered|redistributed|shared)"
_MONTH = r"(?:january|february|march|april|may|june|july|august|september|october|november|december)"
_WARRANTY = r"(?:express~or~implied|expressed~or~implied|implied~or~expressed)"

#: Known sentences (id, pattern), tried in this order.
SENTENCES: list[tuple[str, str]] = [
    ("gnu", r"(?:(?:[^ \n]+~){1,6}is~free~software~)?(?:and~)?(?:you~(?:can|may)~)?redistribute~it~and/or~modify~it~under~the~terms~of~(?:the~|version~(?P<v0>\d(?:\.\d)?)~of~the~)?gnu~(?P<kind>(?:(?:lesser|library|affero)~)?general~public~license)(?:~version~(?P<v1>\d(?:\.\d)?))?(?:~as~published~by~the~free~software~foundation)?(?:~(?:either~)?version~(?P<v2>\d(?:\.\d)?)(?:~of~the~license)?)?(?P<later>~or~(?:at~your~option~)?any~later~version)?"),
    ("ref", rf"(?:(?:this|the|these|all|our|it|unless~otherwise~noted)~(?:[^ \n]+~){{0,6}}?(?:is|are|may~be|can~be)~)?(?:also~|hereby~)?{_VERB}~(?:to~you~)?(?:under|with|by|using|according~to|subject~to)~(?:either~of~)?(?:the~)?(?:terms~(?:and~conditions~)?of~)?(?:either~)?(?:the~|an?~)?{_NAMED}(?:~as~published~by~the~free~software~foundation)?(?:~at~your~option)?(?:~the~license)?(?:~which~(?:is~available~at|accompanies~this~distribution)(?:~[^ \n]+){{0,8}})?(?:~see~(?:the~)?(?:file~)?[^ \n]+(?:~file)?(?:~for~(?:more~)?details)?)?"),
    ("ref", rf"(?:spdx-license-identifier|licen[sc]e|license~type)~(?:is~)?(?:the~)?{_NAMED}"),
    ("title", rf"(?:the~)?{_NAMED}(?:~(?:\d{{1,2}}~)?{_MONTH}~\d{{4}})?"),
    ("free", r"(?:[^ \n]+~){1,6}is~free~software"),
    ("gnu_warranty", rf"(?:this~{_THING}|[^ \n]+)~is~distributed~in~the~hope~that~it~will~be~useful~but~without~any~warranty"),
    ("gnu_implied", r"without~even~the~implied~warranty~of~merchantability~or~fitness~for~a~particular~purpose"),
    ("gnu_see", r"see~the~gnu~(?:(?:lesser|library|affero)~)?general~public~license~for~more~details"),
    ("gnu_copy", r"you~should~have~received~a~copy~of~the~gnu~(?:(?:lesser|library|affero)~)?general~public~license~along~with~(?:this~)?[^ \n]+"),
    ("gnu_where", r"if~not~(?:see(?:~the)?(?:~https?)?~[^ \n]*gnu\.org[^ \n]*|write~to~the~free~software~foundation(?:~[^ \n]+){0,20})"),
    ("apache_may", r"you~may~not~use~this~file~except~in~compliance~with~the~license"),
    ("apache_copy", r"you~may~obtain~a~copy~of~the~license~at(?:~http)?(?:s)?(?:~[^ \n]*apache\.org/licenses/license-2\.0(?:\.txt|\.html)?)?"),
    ("apache_url", r"(?:https?~)?[^ \n]*apache\.org/licenses/license-2\.0(?:\.txt|\.html)?"),
    ("apache_law", rf"unless~required~by~applicable~law~or~agreed~to~in~writing~software~distributed~under~the~license~is~distributed~on~an~as~is~basis~without~warranties~or~conditions~of~any~kind~either~{_WARRANTY}"),
    ("apache_see", r"see~the~license~for~the~specific~language~governing~permissions~and~limitations~under~the~license"),
    ("mit_grant", r"permission~is~hereby~granted~free~of~charge~to~any~person~obtaining~a~copy~of~this~software~and~associated~documentation~files~the~software~to~deal~in~the~software~without~restriction~including~without~limitation~the~rights~to~use~copy~modify~merge~publish~distribute~sublicense~and/or~sell~copies~of~the~software~and~to~permit~persons~to~whom~the~software~is~furnished~to~do~so(?:~subject~to~the~following~conditions)?"),
    ("mit_notice", r"the~above~copyright~notice~and~this~permission~notice(?:~including~the~next~paragraph)?~shall~be~included~in~all~copies~or~substantial~portions~of~the~software"),
    ("mit_as_is", rf"the~software~is~provided~as~is~without~warranty~of~any~kind~{_WARRANTY}~including~but~not~limited~to~the~warranties~of~merchantability~fitness~for~a~particular~purpose~and~non-?infringement"),
    ("mit_liability", r"in~no~event~shall~(?:the~)?(?:authors~or~copyright~holders|[^\n]{1,80}?)~be~liable~for~any~claim~damages~or~other~liability~whether~in~an~action~of~contract~tort~or~otherwise~arising~from~out~of~or~in~connection~with~the~software~or~the~use~or~other~dealings~in~the~software"),
    ("bsd_head", r"redistribution~and~use~in~source~and~binary~forms~with~or~without~modification~are~permitted~provided~that~the~following~conditions~are~met"),
    ("bsd_source", r"(?:1~|a~)?redistributions~of~source~code~must~retain~the~above~copyright~notice~this~list~of~conditions~and~the~following~disclaimer"),
    ("bsd_binary", r"(?:2~|b~)?redistributions~in~binary~form~must~reproduce~the~above~copyright~notice~this~list~of~conditions~and~the~following~disclaimer~in~the~documentation~and/or~other~materials~provided~with~the~distribution"),
    ("bsd_ad", r"(?:3~|c~)?all~advertising~materials~mentioning~features~or~use~of~this~software~must~display~the~following~acknowledge?ment(?:~this~product~includes~software~developed~by(?:~[^ \n]+){1,20})?"),
    ("bsd_ad_text", r"this~product~includes~software~developed~by(?:~[^ \n]+){1,20}"),
    ("bsd_name", r"(?:[34]~|[cd]~)?neither~the~names?~of(?:~[^ \n]+){1,20}~may~be~used~to~endorse~or~promote~products~derived~from~this~software~without~specific~prior~written~permission"),
    ("bsd_as_is", rf"this~software~is~provided~by(?:~[^ \n]+){{1,20}}~as~is~and~any~{_WARRANTY}~warranties~including~but~not~limited~to~the~implied~warranties~of~merchantability~and~fitness~for~a~particular~purpose~are~disclaimed"),
    ("bsd_liability", r"in~no~event~shall(?:~[^ \n]+){1,20}~be~liable~for~any~direct~indirect~incidental~special~exemplary~or~consequential~damages~including~but~not~limited~to~procurement~of~substitute~goods~or~services~loss~of~use~data~or~profits~or~business~interruption~however~caused~and~on~any~theory~of~liability~whether~in~contract~strict~liability~or~tort~including~negligence~or~otherwise~arising~in~any~way~out~of~the~use~of~this~software~even~if~advised~of~the~possibility~of~such~damage"),
    ("isc_grant", r"permission~to~use~copy~modify~and/?(?:or)?~distribute~this~software~for~any~purpose~with~or~without~fee~is~hereby~granted(?:~provided~that~the~above~copyright~notice~and~this~permission~notice~appear~in~all~copies)?"),
    ("isc_as_is", r"the~software~is~provided~as~is~and~the~author~disclaims~all~warranties~with~regard~to~this~software~including~all~implied~warranties~of~merchantability~and~fitness"),
    ("isc_liability", r"in~no~event~shall~the~author~be~liable~for~any~special~direct~indirect~or~consequential~damages~or~any~damages~whatsoever~resulting~from~loss~of~use~data~or~profits~whether~in~an~action~of~contract~negligence~or~other~tortious~action~arising~out~of~or~in~connection~with~the~use~or~performance~of~this~software"),
    ("zlib_as_is", r"this~software~is~provided~as-is~without~any~express~or~implied~warranty"),
    ("zlib_liability", r"in~no~event~will~the~authors~be~held~liable~for~any~damages~arising~from~the~use~of~this~software"),
    ("zlib_grant", r"permission~is~granted~to~anyone~to~use~this~software~for~any~purpose~including~commercial~applications~and~to~alter~it~and~redistribute~it~freely(?:~subject~to~the~following~restrictions)?"),
    ("zlib_notice", r"(?:3~)?this~notice~may~not~be~removed~or~altered~from~any~source~distribution"),
    ("mpl_subject", r"this~source~code~form~is~subject~to~the~terms~of~the~mozilla~public~license~v(?:ersion)?~2\.0"),
    ("mpl_copy", r"if~a~copy~of~the~mpl~was~not~distributed~with~this~file~you~can~obtain~one~at~(?:https?~)?(?:www\.)?mozilla\.org/mpl/2\.0"),
    ("boost_grant", r"permission~is~hereby~granted~free~of~charge~to~any~person~or~organization~obtaining~a~copy~of~the~software~and~accompanying~documentation~covered~by~this~license~the~software~to~use~reproduce~display~distribute~execute~and~transmit~the~software~and~to~prepare~derivative~works~of~the~software~and~to~permit~third-parties~to~whom~the~software~is~furnished~to~do~so(?:~all~subject~to~the~following)?"),
    ("boost_notice", r"the~copyright~notices~in~the~software~and~this~entire~statement~including~the~above~license~grant~this~restriction~and~the~following~disclaimer~must~be~included~in~all~copies~of~the~software~in~whole~or~in~part~and~all~derivative~works~of~the~software~unless~such~copies~or~derivative~works~are~solely~in~the~form~of~machine-executable~object~code~generated~by~a~source~language~processor"),
    ("boost_as_is", rf"the~software~is~provided~as~is~without~warranty~of~any~kind~{_WARRANTY}~including~but~not~limited~to~the~warranties~of~merchantability~fitness~for~a~particular~purpose~title~and~non-?infringement"),
    ("boost_liability", r"in~no~event~shall~the~copyright~holders~or~anyone~distributing~the~software~be~liable~for~any~damages~or~other~liability~whether~in~contract~tort~or~otherwise~arising~from~out~of~or~in~connection~with~the~software~or~the~use~or~other~dealings~in~the~software"),
    ("unlicense", r"this~is~free~and~unencumbered~software~released~into~the~public~domain"),
    ("public_domain", rf"(?:(?:this|the)~{_THING}~(?:is|has~been)~)?(?:hereby~)?(?:placed|released|dedicated|put|in)~(?:in~|into~|to~)?the~public~domain"),
    ("reserved", r"(?:all|some|no)~rights~reserved"),
    ("copyright", r"(?:copyright|©|c)(?:~copyright|~c|~©)?~(?:[^ \n]+~){0,4}?\d{4}[^\n]{0,200}"),
]
IDS = list(dict.fromkeys(i for i, _ in SENTENCES))
#: These make no difference to a licence.
NEUTRAL = {"reserved", "copyright", "free"}
UNKNOWN = "unknown"

#: Licence rules: (licence, or None for what the sentence with the name says; ids with ? for those that may be missing).
_GNU_END = "gnu_warranty? gnu_implied? gnu_see? gnu_copy? gnu_where?"
_APACHE_END = "apache_may apache_copy? apache_url? apache_law? apache_see?"
_BSD_END = "bsd_as_is bsd_liability"
RULES: list[tuple[str | None, str]] = [
    ("MIT", "title? mit_grant mit_notice mit_as_is mit_liability"),
    ("MIT-0", "title? mit_grant mit_as_is mit_liability"),
    ("BSD-4-Clause", f"title? bsd_head bsd_source bsd_binary bsd_ad bsd_ad_text? bsd_name {_BSD_END}"),
    ("BSD-3-Clause", f"title? bsd_head bsd_source bsd_binary bsd_name {_BSD_END}"),
    ("BSD-2-Clause", f"title? bsd_head bsd_source bsd_binary {_BSD_END}"),
    ("ISC", "title? isc_grant isc_as_is isc_liability"),
    ("Zlib", "title? zlib_as_is zlib_liability zlib_grant zlib_notice?"),
    ("BSL-1.0", "title? boost_grant boost_notice? boost_as_is boost_liability"),
    ("MPL-2.0", "mpl_subject mpl_copy?"),
    ("Unlicense", "unlicense"),
    (None, f"gnu {_GNU_END}"),
    (None, f"ref {_APACHE_END}"),
    (None, f"ref {_GNU_END}"),
    ("public-domain", "public_domain"),
    (None, "title"),
]


def _sign(name: str) -> str:
    return chr(0x100 + IDS.index(name))


@lru_cache(maxsize=1)
def _machines():
    whole = "|".join(f"(?P<s{k}>{_compiled(_bare(p))})" for k, (_, p) in enumerate(SENTENCES))
    names = [(re.compile(_compiled(p)), make) for p, make in NAMES]
    rules = [(licence, re.compile("".join(_sign(i.rstrip("?")) + "?" * i.endswith("?") for i in ids.split()))) for licence, ids in RULES]
    return re.compile(f"^(?:{whole})$", re.M), [re.compile(_compiled(p)) for _, p in SENTENCES], names, rules


def names_in(text: str) -> list[str]:
    """The licences that a sentence names, one after another."""
    names, at, found = _machines()[2], 0, []
    while at < len(text):
        best = max(((m.end(), m, make) for p, make in names if (m := p.match(text, at))), key=lambda t: t[0], default=None)
        if best and (best[0] == len(text) or not text[best[0]].isalnum()):
            found.append(best[1].groupdict())
            found[-1] = best[2](found[-1])
            at = best[0]
        step = re.compile(r"[^ \n]*[ \n]+").match(text, at)
        at = step.end() if step else len(text)
    return found


def normalised(text: str) -> tuple[str, list[int], list[tuple[int, int]]]:
    """The words, their places in it and in the text; borders of lines are kept."""
    parts, at, places, length, last = [], [], [], 0, 0
    for m in WORD.finditer(text):
        word = m.group().lower().replace("licence", "license")
        if parts:
            parts.append("\n" if LINE.search(text, last, m.start()) else " ")
            length += 1
        at.append(length)
        parts.append(word)
        length += len(word)
        places.append(m.span())
        last = m.end()
    return "".join(parts), at, places


def sentences(text: str) -> list[tuple[str, list[str], int, int]]:
    """(id, licences named, start, end) of known and unknown licence sentences, in order."""
    low = text.lower()
    if not any(w in low for w in QUICK) or not STEMS.search(text):
        return []
    pattern, single, _, _ = _machines()
    out, start = [], 0
    borders = [m.end() for m in END.finditer(text)]
    for end in [*borders, len(text)]:
        if STEMS.search(text, start, end):
            words, at, places = normalised(text[start:end])

            def hand_on(sid: str, named: list[str], a: int, b: int) -> None:
                out.append((sid, named, start + places[bisect_right(at, a) - 1][0], start + places[bisect_right(at, b - 1) - 1][1]))

            seen = 0
            for m in [*pattern.finditer(words), None]:
                # Between known sentences, lines that speak of licences.
                a, b = (seen, m.start()) if m else (seen, len(words))
                gap = words[a:b].strip("\n")
                if STRONG.search(gap):
                    a += words[a:b].index(gap)
                    hand_on(UNKNOWN, [], a, a + len(gap))
                if not m:
                    break
                seen = m.end()
                k = int(m.lastgroup[1:])
                sid, named = SENTENCES[k][0], []
                if sid in ("ref", "title"):
                    named = names_in(single[k].fullmatch(m.group()).group("names"))
                elif sid == "gnu":
                    g = single[k].fullmatch(m.group()).groupdict()
                    named = [_gnu({"kind": g["kind"], "v": g["v2"] or g["v1"] or g["v0"], "later": g["later"]})]
                if sid == "title" and "licens" not in m.group():
                    continue  # a word such as mit alone
                hand_on(sid, named, m.start(), m.end())
        start = end
    return out


def licences(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Licences and the rest, each (name, start, end) in order of their places."""
    found = [s for s in sentences(text or "") if s[0] not in NEUTRAL]
    ids = "".join("?" if s[0] == UNKNOWN else _sign(s[0]) for s in found)
    out, taken = [], bytearray(len(found))
    for licence, rule in _machines()[3]:
        for m in rule.finditer(ids):
            a, b = m.span()
            taken[a:b] = b"\1" * (b - a)
            said = [licence] if licence else [n for s in found[a:b] for n in s[1]]
            out += [(name, found[a][2], found[b - 1][3]) for name in said]
            ids = ids[:a] + "\0" * (b - a) + ids[b:]
    rest = [(s[0], s[2], s[3]) for s, t in zip(found, taken) if not t]
    return sorted(out, key=lambda t: t[1:]), rest


_SPANS = "array<struct<{}:string,start:int,end:int>>"
SCHEMA = f"doc_id long, licences array<string>, matches {_SPANS.format('licence')}, rest {_SPANS.format('sentence')}"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, licences, matches, rest) for every row: distinct licences in order, their places, and what is in none."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def spans(name: str):
            return pa.list_(pa.struct([(name, pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            distinct, matches, rest = [], [], []
            for value in batch.column(1):
                found, others = licences(value.as_py())
                distinct.append(sorted({n for n, _, _ in found}))
                matches.append([{"licence": n, "start": a, "end": b} for n, a, b in found])
                rest.append([{"sentence": n, "start": a, "end": b} for n, a, b in others])
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(distinct, pa.list_(pa.string())), pa.array(matches, spans("licence")), pa.array(rest, spans("sentence"))], ["doc_id", "licences", "matches", "rest"])

        return one

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, make, SCHEMA).withColumnRenamed("doc_id", id_col)
