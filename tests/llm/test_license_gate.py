"""No rule is kept from a text that its pattern matches."""

import re
from re import _constants as kinds
from re import _parser as parser

from llm_tables import documents  # noqa: F401
from test_native import by_hand

from headway.llm.license_rules import RULES
from headway.llm.licenses import any_keyword, scan

UNGATED = tuple({r._replace(keyword="") for r in RULES})
ONLY = [
    "released under the GNU GPL v3", "CC BY 4.0", "Creative Commons Attribution-ShareAlike 4.0", "distributed under the BSD 3-Clause",
    "LGPL 2.1", "MPL 2.0", "proprietary and confidential", "this product includes software developed by the OpenSSL project",
    "General Public Licence v2", "you just do what the fuck you want to", "OpenRAIL-M", "open database licence", "FreeBSD", "limit",
]


def examples(parsed):
    texts = [""]
    for kind, value in parsed:
        if kind is kinds.SUBPATTERN:
            more = examples(value[3])
        elif kind is kinds.BRANCH:
            more = [t for branch in value[1] for t in examples(branch)]
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
            more = [t * value[0] for t in examples(value[2])] + ([] if value[0] else examples(value[2]))
        elif kind is kinds.IN:
            more = ["3" if value[0][0] is kinds.CATEGORY else chr(value[0][1] if value[0][0] is kinds.LITERAL else value[0][1][0])]
        else:
            more = ["q" if kind is kinds.ANY else chr(value)]
        texts = [t + m for t in texts for m in more]
    return texts


def test_every_match_holds_a_keyword():
    of = {}
    for r in RULES:
        of.setdefault(r[:3] + (r.pattern,), []).append(r.keyword)
    gate = re.compile(any_keyword(RULES))
    for (label, _, _, pattern), words in of.items():
        for text in examples(parser.parse(pattern)):
            assert re.fullmatch(pattern, text), (label, text)
            assert any(w in f" {text} " for w in words) and gate.search(f" {text} "), (label, text)


def test_texts_of_one_match_alone(documents):
    texts = ONLY + sorted({examples(parser.parse(r.pattern))[-1] for r in RULES if "dual" not in r.pattern})
    got = {r.doc_id: (r.labels, r.score) for r in scan(documents(list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        assert got[k] == by_hand(text, UNGATED)[-2:], text
        assert (got[k][0] == "") == (text == "limit"), text
