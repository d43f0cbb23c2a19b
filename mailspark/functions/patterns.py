"""Regular expressions of the mail grammar, valid in both Java and Python.

Repeated groups are possessive, so matching is linear and does not recurse on long headers.
"""

import re

# A class of characters, and in it an escape, a range and a plain character.
_CLASS = re.compile(r"\[(\^?)((?:[^\]\\]|\\.)+)\]")
_ITEM = re.compile(r"\\x[0-9a-f]{2}|\\u[0-9a-f]{4}|\\.|.")
_SPACES = "\t\n\x0b\f\r "


def spelled(pattern: str) -> str:
    """The pattern with the ranges and the white space of its classes spelled out, as far as they are Latin-1.

    Java looks single characters of a class up in a table; it tests each range, and each class within a class, apart.
    """

    def number(item: str) -> int:
        return int(item[2:], 16) if item[:2] in ("\\x", "\\u") else ord({"\\t": "\t", "\\n": "\n", "\\r": "\r"}.get(item, item[-1]))

    def spell(found: re.Match) -> str:
        items, out, at = _ITEM.findall(found[2]), [], 0
        while at < len(items):
            if items[at] == r"\s":
                out += [f"\\x{ord(c):02x}" for c in _SPACES]
            elif items[at + 1 : at + 2] == ["-"] and at + 2 < len(items):
                first, last = number(items[at]), number(items[at + 2])
                out += [f"\\x{c:02x}" for c in range(first, last + 1)] if last < 256 else items[at : at + 3]
                at += 2
            else:
                out.append(f"\\x{number(items[at]):02x}")
            at += 1
        return f"[{found[1]}{''.join(out)}]"

    return _CLASS.sub(spell, pattern)


QUOTED = r'"(?:[^"\\]++|\\.)*+"'
COMMENT = r"\((?:[^()\\]++|\\.|\((?:[^()\\]++|\\.)*+\))*+\)"
ANGLE = rf'<(?:{QUOTED}|[^<>"]++|")*+>'
GROUP = rf'(?:{QUOTED}|[^",;:<>()@\[\]]++)++:(?:{QUOTED}|{COMMENT}|[^";(]++)*+;'

GROUP_MEMBERS = rf'^(?:{QUOTED}|[^",;:<>()@\[\]]++)++:((?:{QUOTED}|{COMMENT}|[^";(]++)*+);$'

# One entry of an address list; commas and semicolons inside quotes, comments and groups do not split.
LIST_ENTRY = rf'(?:{GROUP}|(?:{QUOTED}|{COMMENT}|{ANGLE}|[^",;(<]++|["(<])++)'

_WORD = r"[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]++"
_PLAIN_SPEC = r'[^\s"(),:;<>@\[\]\\]++@[^\s"(),:;<>@\[\]\\]++'

# Address text that formatting would not change: a bare address, or one with a name that either needs
# no quotes or has quotes and needs them.
_PLAIN_NAME = rf"{_WORD}(?: {_WORD})*+"
_QUOTED_NAME = r'"(?=[^"]*?[()<>@,;:.\[\]])[^"\\\x00-\x1f]++"'
CANONICAL = rf"(?:(?:{_PLAIN_NAME}|{_QUOTED_NAME}) <{_PLAIN_SPEC}>|{_PLAIN_SPEC})"

# A whole list of such addresses, and its entries; quotes a name does not need.
CANONICAL_LIST = rf"^{CANONICAL}(?:,\s*+{CANONICAL})*+$"
CANONICAL_ENTRY = r'(?:"[^"]*+"|[^\s",])(?:"[^"]*+"|[^",]++)*+'
NEEDLESS_QUOTES = rf'(^|,[ \t]*+)"({_PLAIN_NAME})"(?= <)'

# Everything before the angle bracket, and the address inside it.
PHRASE = rf'((?:{QUOTED}|{COMMENT}|[^"(<]++|["(])*+)<'
IN_ANGLE = rf'(?:{QUOTED}|{COMMENT}|[^"(<]++|["(])*+<((?:{QUOTED}|[^<>"]++)*+)>?'
COMMENT_TEXT = rf"\(((?:[^()\\]++|\\.|\((?:[^()\\]++|\\.)*+\))*+)\)"

# A display name with one of these must be quoted; an address with one of these goes in brackets.
NEEDS_QUOTES = r'[()<>@,;:\\".\[\]]|[^\t -~]'
NOT_SIMPLE = r'[()<>,;:\\"\[\]]'

_ATOM = r'[^\x00-\x20\x7f()<>@,;:\\".\[\]]++'
_LOCAL = rf"(?:{_ATOM}(?:\.{_ATOM})*+|{QUOTED})"
_LABEL = r"[A-Za-z0-9\u0080-\uffff-]++"
_DOMAIN = rf"(?:{_LABEL}(?:\.{_LABEL})*+|\[[^\[\]\s]*+\])"
_SPEC = rf"{_LOCAL}(?:@{_DOMAIN})?+"
_ROUTE = rf"(?:@{_DOMAIN}(?:,@{_DOMAIN})*+:)?+"

# Exactly one well-formed address, with or without a display name; the domain may be missing.
VALID_ADDRESS = (
    rf'^\s*+(?:{GROUP}|(?:{QUOTED}|{COMMENT}|[^"(<>,;:\\]++)*+<\s*+{_ROUTE}{_SPEC}\s*+>'
    rf"|(?:{COMMENT}\s*+)*+{_SPEC})\s*+(?:{COMMENT}\s*+)*+$"
)

# Lists of addresses that are valid and that formatting would not change, kept apart by a control
# character; and the bare addresses in such a list.
SEPARATOR = "\x01"
_ASCII_ATOM = r'[!#-\x27*+\-/-9=?A-Z^-~]++'
_ASCII_SPEC = rf"{_ASCII_ATOM}(?:\.{_ASCII_ATOM})*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"
_ASCII_QUOTED = r'"(?=[^"]*?[()<>@,;:.\[\]])[ !#-\[\]-~]++"'
_READY = rf"(?:{_ASCII_SPEC}|(?:{_PLAIN_NAME}|{_ASCII_QUOTED}) <{_ASCII_SPEC}>)"
READY_LIST = rf"^{_READY}(?:\x01{_READY})*+$"
READY_SPEC = r'(?:^|\x01)(?:(?:"[^"]*+" |[^"<\x01]*+)<)?+([^<>\x01]++)'

# RFC 2047 words: charset, encoding, text.
ENCODED_WORD = r"=\?([^?*\s]++)(?:\*[^?\s]*+)?+\?([bBqQ])\?([^?]*+)\?="
BETWEEN_WORDS = r"(=\?[^?\s]++\?[bBqQ]\?[^?]*+\?=)[ \t\r\n]++(?==\?[^?\s]++\?[bBqQ]\?[^?]*+\?=)"
WORD_OR_TEXT = r"=\?[^?\s]++\?[bBqQ]\?[^?]*+\?=|[^=]++|="

# Fixed value: characters of the longest line that may be sent.
MAX_LINE = 998

# Header text that must be sent as encoded words: not printable ASCII, looks encoded already, has
# outer blanks, or has a run without a blank, where it cannot be folded, that leaves no room in a line
# for the header's name and a folded piece before it.
NEEDS_ENCODING = rf"[^ -~]|=\?|^ | $|[^ ]{{{MAX_LINE // 5 + 1}}}"

# Body text that must not be sent as it is: not 7-bit, a line too long, or a lone CR or LF.
NEEDS_BASE64 = rf"[^\x01-\x7f]|(?<!\r)\n|\r(?!\n)|(?<![^\r\n])[^\r\n]{{{MAX_LINE + 1}}}"

LINE_BREAK = r"[\r\n]"

# Date header: the usual form, and the pieces of older ones.
USUAL_DATE = r"^(?:[A-Za-z]{3}, )?(\d{1,2} [A-Za-z]{3} \d{4} \d\d:\d\d:\d\d [+-]\d{4})$"

CANONICAL_LIST, CANONICAL_ENTRY, NEEDLESS_QUOTES = map(spelled, (CANONICAL_LIST, CANONICAL_ENTRY, NEEDLESS_QUOTES))
READY_LIST, VALID_ADDRESS, LIST_ENTRY = map(spelled, (READY_LIST, VALID_ADDRESS, LIST_ENTRY))
NEEDS_BASE64, NEEDS_ENCODING, USUAL_DATE = map(spelled, (NEEDS_BASE64, NEEDS_ENCODING, USUAL_DATE))
