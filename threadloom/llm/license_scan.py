"""License scans by ordered signature rules. DataFrame operations only.

A rule is a regex with a keyword, a label, a priority (its place in the list) and a confidence. Texts without any hint of a license are passed over by
one cheap test; in the others a rule runs only if its keyword stands in the text. What rules find are intervals of the text: one that lies within
another is suppressed by it, and of equal intervals the rule of higher priority stays. Base phrases are looked for among the words
and always keep their labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import once
from .common import ascii_lower
from .decontamination import SEPARATORS

#: Phrase of consecutive words: label. Fixed values of the contract.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Rules by hand: keyword | label | confidence | regex over the text in lower case; "~" stands for what may be between two words.
TEXTS = r"""
permission is hereby granted | mit | 0.95 | permission~is~hereby~granted~free~of~charge~to~any~person~obtaining~a~copy
redistribution and use | bsd-3-clause | 0.95 | redistribution~and~use~in~source~and~binary~forms[\s\S]{0,900}?neither~the~name
redistribution and use | bsd-2-clause | 0.85 | redistribution~and~use~in~source~and~binary~forms~with~or~without~modification
advertising materials | bsd-4-clause | 0.9 | all~advertising~materials~mentioning~features
permission distribute | isc | 0.9 | permission~to~use~copy~modify~and~(?:or~)?distribute~this~software~for~any~purpose
implied warranty | zlib | 0.9 | this~software~is~provided~as~is~without~any~express~or~implied~warranty
misrepresented | zlib | 0.95 | the~origin~of~this~software~must~not~be~misrepresented
boost software | bsl-1.0 | 0.95 | boost~software~license(?:~version~1\.0)?
free and unencumbered | unlicense | 0.98 | this~is~free~and~unencumbered~software~released~into~the~public~domain
what the fuck | wtfpl | 0.98 | do~what~the~fuck~you~want~to~public~license
beer | beerware | 0.8 | beer\W{0,2}ware~license
artistic license | artistic | 0.9 | artistic~license(?:~(?:version~)?[12]\.0)?
eclipse public | epl | 0.95 | eclipse~public~license(?:~v(?:ersion)?~?[12]\.0)?
eclipse | edl | 0.95 | eclipse~distribution~license
mozilla public | mpl | 0.95 | mozilla~public~license(?:~v(?:ersion)?~?[12]\.[01])?
common development | cddl | 0.95 | common~development~and~distribution~license(?:~v(?:ersion)?~?1\.[01])?
common public license | cpl | 0.9 | common~public~license(?:~v(?:ersion)?~?1\.0)?
european union public | eupl | 0.95 | european~union~public~licen[cs]e(?:~v(?:ersion)?~?1\.[012])?
gnu lesser | lgpl | 0.97 | gnu~lesser~general~public~licen[cs]e
gnu | lgpl | 0.95 | gnu~library~general~public~licen[cs]e
lesser general public | lgpl | 0.9 | lesser~general~public~licen[cs]e
gnu affero | agpl | 0.97 | gnu~affero~general~public~licen[cs]e
affero general public | agpl | 0.92 | affero~general~public~licen[cs]e
gnu general public | gpl | 0.97 | gnu~general~public~licen[cs]e
general public licen | gpl | 0.8 | general~public~licen[cs]e
gnu free documentation | gfdl | 0.97 | gnu~free~documentation~licen[cs]e
free software foundation | gpl-notice | 0.6 | published~by~the~free~software~foundation
apache licen | apache-2.0 | 0.97 | apache~licen[cs]e~(?:version~)?v?2(?:\.0)?\b
apache licen | apache-1.1 | 0.97 | apache~(?:software~)?licen[cs]e~(?:version~)?v?1\.[01]\b
apache licen | apache | 0.9 | apache~licen[cs]e
apache software license | apache | 0.9 | apache~software~licen[cs]e
academic free | afl | 0.95 | academic~free~licen[cs]e
open software licen | osl | 0.9 | open~software~licen[cs]e
python software foundation | psf | 0.95 | python~software~foundation~licen[cs]e
php license | php | 0.9 | php~licen[cs]e(?:~v(?:ersion)?~?3\.0[01]?)?
ruby license | ruby | 0.85 | ruby~licen[cs]e
zope public | zpl | 0.95 | zope~public~licen[cs]e
w3c | w3c | 0.85 | w3c~(?:software~(?:notice~and~)?)?licen[cs]e
unicode | unicode-dfs | 0.85 | unicode~(?:inc~)?licen[cs]e~agreement
sil open font | ofl-1.1 | 0.97 | sil~open~font~licen[cs]e
open font license | ofl | 0.85 | open~font~licen[cs]e
open data commons | odc | 0.85 | open~data~commons
open database license | odbl | 0.95 | open~database~licen[cs]e
open government licen | ogl | 0.95 | open~government~licen[cs]e
creative commons zero | cc0-1.0 | 0.97 | creative~commons~zero
cc0 | cc0-1.0 | 0.9 | \bcc0\b(?:~1\.0)?
public domain | public-domain | 0.7 | (?:in|into|to)~the~public~domain
creative commons | cc | 0.8 | creative~commons
x11 license | x11 | 0.9 | x11~licen[cs]e
bsd license | bsd | 0.85 | bsd~licen[cs]e
bsd | bsd | 0.7 | bsd~style~licen[cs]e
mit license | mit | 0.95 | mit~licen[cs]e
expat license | mit | 0.9 | expat~licen[cs]e
isc license | isc | 0.9 | isc~licen[cs]e
zlib license | zlib | 0.9 | zlib(?:~libpng)?~licen[cs]e
ncsa | ncsa | 0.9 | ncsa~open~source~licen[cs]e
microsoft public | ms-pl | 0.95 | microsoft~public~licen[cs]e
microsoft reciprocal | ms-rl | 0.95 | microsoft~reciprocal~licen[cs]e
server side public | sspl | 0.95 | server~side~public~licen[cs]e
business source | busl | 0.9 | business~source~licen[cs]e
elastic license | elastic | 0.9 | elastic~licen[cs]e
commons clause | commons-clause | 0.95 | commons~clause
postgresql licen | postgresql | 0.95 | postgresql~licen[cs]e
openssl license | openssl | 0.95 | openssl~licen[cs]e
openrail | openrail | 0.9 | openrail(?:\W?m)?\b
llama | llama-community | 0.85 | llama~(?:[0-9.]+~)?community~licen[cs]e
mulan | mulan-psl | 0.9 | mulan~(?:psl|permissive~software~licen[cs]e)
blue oak | blueoak | 0.9 | blue~oak~model~licen[cs]e
universal | upl-1.0 | 0.85 | universal~permissive~licen[cs]e
licensed apache compliance | apache-2.0 | 0.95 | you~may~not~use~this~file~except~in~compliance~with~the~license
specific language governing | apache-notice | 0.7 | see~the~license~for~the~specific~language~governing~permissions
redistribute modify | gpl-notice | 0.85 | you~can~redistribute~it~and~or~modify~it~under~the~terms~of~the~gnu
hope | gpl-notice | 0.75 | distributed~in~the~hope~that~it~will~be~useful~but~without~any~warranty
received copy | gpl-notice | 0.8 | you~should~have~received~a~copy~of~the~gnu
merchantability fitness | warranty-disclaimer | 0.4 | merchantability(?:~and~|~or~|~)fitness~for~a~particular~purpose
warranty kind | warranty-disclaimer | 0.5 | provided~as~is~without~warranty~of~any~kind
disclaims | isc | 0.85 | the~author~disclaims~all~warranties~with~regard~to~this~software
sublicense | mit | 0.9 | to~use~copy~modify~merge~publish~distribute~sublicense~and~or~sell
portions | mit | 0.85 | included~in~all~copies~or~substantial~portions~of~the~software
redistributions retain | bsd | 0.85 | redistributions~of~source~code~must~retain~the~above~copyright
redistributions reproduce | bsd | 0.85 | redistributions~in~binary~form~must~reproduce~the~above~copyright
endorse | bsd-3-clause | 0.85 | used~to~endorse~or~promote~products~derived~from~this~software
mozilla subject | mpl-2.0 | 0.97 | subject~to~the~terms~of~the~mozilla~public~license
incompatible secondary | mpl-2.0-no-copyleft | 0.95 | incompatible~with~secondary~licenses
eclipse | epl | 0.95 | terms~of~the~eclipse~public~license
boost | bsl-1.0 | 0.97 | distributed~under~the~boost~software~license
waived | cc0-1.0 | 0.9 | waived~all~copyright~and~related~or~neighbou?ring~rights
dedicated domain | public-domain | 0.85 | dedicated~to~the~public~domain
placed domain | public-domain | 0.8 | placed~in~the~public~domain
whatever | beerware | 0.9 | as~long~as~you~retain~this~notice~you~can~do~whatever
adaptive public | apl-1.0 | 0.9 | adaptive~public~license
aladdin free | aladdin | 0.9 | aladdin~free~public~license
apple source | apsl | 0.9 | apple~public~source~license(?:~v(?:ersion)?~?[12]\.[0-2])?
attribution assurance | aal | 0.9 | attribution~assurance~license
bittorrent | bittorrent | 0.9 | bittorrent~open~source~license
cern | cern-ohl | 0.95 | cern~open~hardware~licen[cs]e
cnri | cnri-python | 0.85 | cnri~(?:open~source~)?(?:gpl~compatible~)?license
condor | condor | 0.85 | condor~public~license
educational community | ecl-2.0 | 0.95 | educational~community~license
eiffel forum | efl-2.0 | 0.9 | eiffel~forum~license
entessa | entessa | 0.9 | entessa~public~license
fair license | fair | 0.7 | fair~license
frameworx | frameworx | 0.9 | frameworx~(?:open~)?license
freetype project | ftl | 0.9 | freetype~(?:project~)?licen[cs]e
historical disclaimer | hpnd | 0.9 | historical~permission~notice~and~disclaimer
ibm public | ipl-1.0 | 0.9 | ibm~public~license
imagemagick | imagemagick | 0.85 | imagemagick~licen[cs]e
jpeg | ijg | 0.9 | independent~jpeg~group
intel source | intel | 0.8 | intel~open~source~license
jython | jython | 0.85 | jython~licen[cs]e
latex | lppl | 0.95 | latex~project~public~license
leptonica | leptonica | 0.8 | leptonica~licen[cs]e
libpng | libpng | 0.85 | libpng~licen[cs]e
lucent public | lpl | 0.9 | lucent~public~license
miros | miros | 0.9 | miros~licen[cs]e
motosoto | motosoto | 0.9 | motosoto~open~source~license
nasa | nasa-1.3 | 0.95 | nasa~open~source~agreement
naumen public | naumen | 0.9 | naumen~public~license
nethack general | ngpl | 0.95 | nethack~general~public~license
nokia source | nokia | 0.85 | nokia~open~source~license
profit | nposl-3.0 | 0.9 | non~?profit~open~software~license
opensource reciprocal public | rpl | 0.9 | reciprocal~public~license
open group | opengroup | 0.8 | open~group~test~suite~license
openldap public | oldap | 0.95 | openldap~public~license
ricoh source | rscpl | 0.9 | ricoh~source~code~public~license
realnetworks | rpsl | 0.9 | realnetworks~public~source~license
simple public | simpl-2.0 | 0.8 | simple~public~license
sleepycat | sleepycat | 0.95 | sleepycat~licen[cs]e
standards source | sissl | 0.9 | sun~industry~standards~source~license
sun public | spl-1.0 | 0.9 | sun~public~license
sybase watcom | watcom-1.0 | 0.9 | sybase~open~watcom~public~license
vovida | vsl-1.0 | 0.9 | vovida~software~license
windows | wxwindows | 0.95 | wx~?windows~library~licen[cs]e
xerox | xerox | 0.8 | xerox~licen[cs]e
parity public | parity | 0.85 | parity~public~license
prosperity | prosperity | 0.85 | prosperity~public~license
polyform | polyform | 0.95 | polyform~(?:noncommercial|small~business|shield|strict|free~trial|perimeter)~license
hippocratic | hippocratic | 0.9 | hippocratic~license
commercial | research-only | 0.6 | for~non~?commercial~research~(?:purposes~)?only
evaluation purposes | evaluation-only | 0.5 | for~evaluation~purposes~only
trade secrets | proprietary | 0.5 | contains~trade~secrets
reproduction prohibited | proprietary | 0.5 | (?:unauthori[sz]ed~)reproduction~(?:or~distribution~)?is~(?:strictly~)?prohibited
terms service | terms-of-service | 0.3 | subject~to~(?:our|the|these)~terms~of~service
all rights reserved | all-rights-reserved | 0.5 | all~rights~reserved
proprietary | proprietary | 0.5 | proprietary~and~confidential
copyright | copyright-notice | 0.3 | copyright~(?:\(c\)|©)?~?(?:19|20)[0-9]{2}
"""
# Families whose identifiers, short forms and addresses follow one scheme: stem | versions | keyword.
FAMILIES = """
gpl | 1.0 2.0 3.0 | gpl
lgpl | 2.0 2.1 3.0 | lgpl
agpl | 1.0 3.0 | agpl
gfdl | 1.1 1.2 1.3 | gfdl
mpl | 1.0 1.1 2.0 | mpl
epl | 1.0 2.0 | epl
eupl | 1.0 1.1 1.2 | eupl
cddl | 1.0 1.1 | cddl
cpal | 1.0 | cpal
osl | 1.0 2.0 2.1 3.0 | osl
afl | 1.1 1.2 2.0 2.1 3.0 | afl
ofl | 1.0 1.1 | ofl
apache | 1.0 1.1 2.0 | apache
artistic | 1.0 2.0 | artistic
bsl | 1.0 | bsl
zpl | 1.1 2.0 2.1 | zpl
lppl | 1.0 1.1 1.2 1.3 | lppl
ecl | 1.0 2.0 | ecl
cecill | 1.0 1.1 2.0 2.1 | cecill
odbl | 1.0 | odbl
"""
#: Creative Commons kinds and versions.
CC_KINDS, CC_VERSIONS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"), ("1.0", "2.0", "2.5", "3.0", "4.0")
CC_WORDS = {"by": "attribution", "sa": "share~?alike", "nd": "no~?deriv(?:ative)?s?", "nc": "non~?commercial"}
#: Words of a rule's keywords that stand in too many texts to be its gate, if it has another.
COMMON = ("licen", "license", "software", "public", "general", "open", "free", "common", "provided", "what", "the", "use", "blue", "side", "is", "granted", "permission", "copy", "received", "hope", "useful", "kind", "terms", "service", "fair", "simple", "group", "subject", "opensource", "nonprofit", "sun", "trade", "source")
#: What must be there besides a keyword that is a part of common words.
GATES = {"cc": r"cc[\W_]+by"} | {
    phrase.split()[at]: phrase.replace(" ", r"\W{1,6}")
    for at, phrase in ((0, "general public"), (0, "common public"), (1, "open software"), (2, "in the hope"), (1, "have received"), (1, "open group"), (0, "simple public"), (1, "sun public"), (2, "terms of service"),
                       (0, "evaluation purposes"), (0, "placed in the public"), (0, "dedicated to the public"), (0, "historical permission"), (0, "educational community"), (1, "common development"))
}
GATES |= {stem: rf"\b\w?{stem}\W{{0,6}}v?[0-9]" for stem in (line.split("|")[2].strip() for line in FAMILIES.strip().splitlines()) if len(stem) <= 4}
#: Words of base phrases that gate them.
BASE_GATES = ("gnu", "licen", "cc")
#: A text is searched in pieces of PIECE characters, each with REACH more behind it, the length of what a rule finds at most.
PIECE, REACH = 8192, 2048
#: Stands about what a rule found. No character, so no text has a use for it; one that is there is taken for another such.
EDGE, OTHER_EDGE = "\uFDD0", "\uFDD1"


def rules() -> list[tuple[int, str, str, str, float]]:
    """(priority, keyword, label, regex, confidence): identifiers first, then versions, then texts by hand; hundreds from the tables above."""
    between = r"\W{1,6}"
    made: list[tuple[str, str, str, float]] = []
    families = [[x.strip() for x in line.split("|")] for line in FAMILIES.strip().splitlines()]
    for stem, versions, keyword in families:
        for version in versions.split():
            short, name = version.removesuffix(".0"), f"{stem}-{version}"
            number = version.replace(".", r"\.")
            made += [
                ("spdx-license-identifier", name, rf"spdx-license-identifier:\s{{0,40}}{stem}-{number}(?:-only|-or-later|\+)?", 1.0),
                (keyword, name, rf"\b{stem}(?:{between}|)v?{number}(?:\+|{between}or{between}later)?(?![0-9.])", 0.9),
                (keyword, name, rf"\b{stem}v{short.replace('.', r'\.')}\+?(?![0-9.])", 0.85),
            ]
    for kind in CC_KINDS:
        words = between.join(CC_WORDS[k] for k in kind.split("-")).replace("~", between.replace("1", "0", 1))
        for version in CC_VERSIONS:
            number = version.replace(".", r"\.")
            made.append(("cc", f"cc-{kind}-{version}", rf"\bcc{between}{kind.replace('-', between)}{between}{number}(?![0-9])", 0.95))
            made.append(("creativecommons.org", f"cc-{kind}-{version}", rf"creativecommons\.org/licenses/{kind}/{number}", 1.0))
            made.append(("creative", f"cc-{kind}-{version}", rf"creative{between}commons{between}{words}{between}(?:v(?:ersion)?\W?)?{number}(?![0-9])", 0.97))
        made.append(("cc", f"cc-{kind}", rf"\bcc{between}{kind.replace('-', between)}(?![a-z])", 0.85))
        made.append(("creative", f"cc-{kind}", rf"creative{between}commons{between}{words}", 0.9))
    for plain in ("mit", "isc", "zlib", "x11", "ncsa", "unlicense", "wtfpl", "0bsd", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause", "cc0-1.0", "postgresql", "openssl", "python-2.0", "ruby", "upl-1.0", "blueoak-1.0.0"):
        made.append(("spdx-license-identifier", plain, rf"spdx-license-identifier:\s{{0,40}}{plain.replace('.', r'\.')}\b", 1.0))
    for line in TEXTS.strip().splitlines():
        keyword, label, confidence, regex = (x.strip() for x in line.split(" | ", 3))
        made.append((_gate_word(keyword), label, regex.replace("~?", r"\W{0,6}").replace("~", between), float(confidence)))
    return [(i, keyword, label, regex, confidence) for i, (keyword, label, regex, confidence) in enumerate(made)]


def _gate_word(keywords: str) -> str:
    words = [w.strip("',") for w in keywords.split()]
    return max([w for w in words if w not in COMMON] or words, key=len)


def _cover(made: list[tuple[int, str, str, str, float]]) -> list[str]:
    """The keywords that let through every text with a base phrase or any keyword: those that hold no other one."""
    words = {r[1] for r in made} | set(BASE_GATES)
    return sorted(w for w in words if not any(other != w and other in w and other not in GATES for other in words))


#: A text without any of these has neither base phrase nor rule.
HINT = "|".join(_cover(rules()))


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _passes(low: str, keywords: list[str]) -> str:
    """SQL, since hundreds of patterns are built faster as one text than call by call."""
    return "(" + " OR ".join(f"contains({low}, {_quoted(k)})" + (f" AND rlike({low}, {_quoted(GATES[k])})" if k in GATES else "") for k in keywords) + ")"


def _matches(piece: str, made: list[tuple[int, str, str, str, float]]) -> str:
    """SQL of (priority, marked) of each rule that finds something in a piece; marked is the piece with EDGE about what was found. A rule runs only if its keyword's gate
    passes. Patterns are constants, so each is compiled once in a task."""
    by: dict[str, list] = {}
    for rule in made:
        by.setdefault(rule[1], []).append(rule)
    marked = lambda r: f"named_struct('priority', {r[0]}, 'marked', regexp_replace({piece}, {_quoted(r[3])}, '{EDGE}$0{EDGE}'))"
    groups = ", ".join(f"CASE WHEN {_passes(piece, [k])} THEN array({', '.join(map(marked, v))}) END" for k, v in by.items())
    return f"filter(flatten(filter(array({groups}), g -> g IS NOT NULL)), m -> contains(m.marked, '{EDGE}'))"


def _intervals(match: Column, base: Column, lead: Column) -> Column:
    """(start, back, priority) in the whole text of what a rule found in a piece, as far as it begins there; back, the negative end, makes the longer come first."""
    begin = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.array().cast("array<struct<start:int,back:int,priority:int>>").alias("spans"))

    def step(acc: Column, part: Column) -> Column:
        end = acc["at"] + F.length(part)
        here = acc["inside"] & (acc["at"] >= lead) & (acc["at"] < lead + PIECE)
        span = F.struct((base + acc["at"] - lead).alias("start"), (lead - base - end).alias("back"), match["priority"].alias("priority"))
        return F.struct(end.alias("at"), (~acc["inside"]).alias("inside"), F.when(here, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(F.split(match["marked"], EDGE, -1), begin, step, lambda acc: acc["spans"])


def _unsuppressed(found: Column, upto: Column) -> Column:
    """Those of a piece's sorted intervals that no interval before them holds: sorted by start and longest first, that is a running greatest end. upto: the greatest
    end of the piece before; those before it do not reach as far."""
    begin = F.struct(upto.alias("upto"), F.array().cast("array<struct<start:int,back:int,priority:int>>").alias("kept"))
    step = lambda acc, d: F.when(-d["back"] <= acc["upto"], acc).otherwise(F.struct((-d["back"]).alias("upto"), F.array_append(acc["kept"], d).alias("kept")))
    return F.aggregate(found, begin, step, lambda acc: acc["kept"])


def _detections(rows: DataFrame, made: list[tuple[int, str, str, str, float]]) -> DataFrame:
    """Adds found: (start, back, priority) of the detections of text that stay, in order; empty for a null text.

    Texts are cut into pieces, whose matches are bounded, so the work grows with a text's length and not with the square of its matches.
    """
    none = F.array().cast("array<string>")
    text = F.translate("text", EDGE, OTHER_EDGE)
    rows = once(rows, __parts=F.coalesce(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0)), none))
    parts = F.col("__parts")
    before = lambda i: F.coalesce(F.right(F.try_element_at(parts, F.when(i > 0, i)), F.lit(1)), F.lit(""))  # noqa: E731  for what a word's edge goes by
    after = lambda i: F.coalesce(F.left(F.try_element_at(parts, i + 2), F.lit(REACH)), F.lit(""))
    rows = once(rows, __pieces=F.transform(parts, lambda p, i: F.struct((i * PIECE).alias("base"), F.length(before(i)).alias("lead"), F.concat(before(i), p, after(i)).alias("piece"))))
    rows = once(rows, __matches=F.expr(f"transform(__pieces, p -> {_matches('p.piece', made)})"))
    piece = lambda i: F.element_at("__pieces", i + 1)
    each = lambda matches, i: F.flatten(F.transform(matches, lambda m: _intervals(m, piece(i)["base"], piece(i)["lead"])))
    rows = once(rows, __each=F.transform("__matches", lambda ms, i: F.sort_array(each(ms, i)))).drop("__matches")
    rows = once(rows, __ends=F.transform("__each", lambda f: F.coalesce(-F.array_min(F.transform(f, lambda d: d["back"])), F.lit(-1))))
    upto = lambda i: F.coalesce(F.try_element_at(F.col("__ends"), F.when(i > 0, i)), F.lit(-1))
    return once(rows, found=F.flatten(F.transform("__each", lambda f, i: _unsuppressed(f, upto(i))))).drop("__parts", "__pieces", "__each", "__ends")


def _base_places(words: Column) -> Column:
    """(start, label) of every base phrase."""

    def places(phrase: str, label: str) -> Column:
        parts = phrase.split()

        def at(word: Column, i: Column) -> Column:
            here = word == parts[0]
            for k, part in enumerate(parts[1:], 2):
                here = here & F.coalesce(F.try_element_at(words, i + k) == part, F.lit(False))
            return F.when(here, F.struct(i.alias("start"), F.lit(label).alias("label")))

        return F.filter(F.transform(words, at), lambda x: x.isNotNull())

    each = [places(phrase, label) for phrase, label in BASE.items()]
    return F.flatten(F.array(*each))


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans for each row of docs.

    spans: (start, end, label, confidence) in characters of the detections that stay; score: the greatest confidence, at least 0.6 with a base phrase, 0
    without any. A null or empty text has no words and no detections (labels are empty strings). Every row is worked on by itself, so
    repeated rows and null ids are kept as they come. Other columns are not read.
    """
    text, made = F.col("text"), rules()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n_words = F.size(F.array_remove(F.split(text, SEPARATORS), "")).cast("long")
    rows = once(rows.select("doc_id", "text", n_words.alias("n_words"), F.lower(text).alias("low")), hinted=F.expr(_passes("low", _cover(made))))
    rows = once(rows.select("doc_id", "n_words", F.when(F.col("hinted"), ascii_lower(text)).alias("text")), words=F.array_remove(F.split(text, SEPARATORS), ""))
    rows = _detections(once(rows, base=F.coalesce(F.when(text.isNotNull(), _base_places(F.col("words"))), F.array().cast("array<struct<start:int,label:string>>"))), made)
    label, confidence = F.split(F.lit(",".join(r[2] for r in made)), ","), F.split(F.lit(",".join(str(r[4]) for r in made)), ",").cast("array<double>")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base_labels = F.transform("base", lambda b: b["label"])
    spans = F.transform("found", lambda d: F.struct(d["start"].alias("start"), (-d["back"]).alias("end"), F.element_at(label, d["priority"] + 1).alias("label"), F.element_at(confidence, d["priority"] + 1).alias("confidence")))
    rows = once(rows.select("doc_id", "n_words", "base", "found"), spans=spans)
    labels = F.concat(base_labels, F.transform("spans", lambda d: d["label"]))
    starts = F.transform("base", lambda b: b["start"].cast("long"))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(labels).alias("labels"),
        F.greatest(F.coalesce(F.array_max(F.transform("spans", lambda d: d["confidence"])), F.lit(0.0)), F.when(F.size("base") > 0, 0.6).otherwise(0.0)).alias("score"), "spans",
    )
