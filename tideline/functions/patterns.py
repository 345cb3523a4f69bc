"""Character classes shared by the text functions and their SQL checks.

They spell out what Python's ``str.isspace`` and ``str.splitlines`` accept, in
an escape syntax that both Java regular expressions and RE2 read the same way.
"""

# Characters that end a line; \r\n counts as one break.
BREAKS = r"\n\x{0b}\x{0c}\r\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}"

# Whitespace that does not end a line.
INLINE = r"\t\x{1f}\x{20}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"

SPACE = BREAKS + INLINE

ONE_BREAK = rf"(?:\r\n|[{BREAKS}])"

# One line with its break, or the last line without one.
LINE = rf"[^{BREAKS}]*{ONE_BREAK}|[^{BREAKS}]+"

# The same in Java's own syntax.  Almost every character of a text is an ordinary one,
# so these settle that with two range tests before they look at the rare ones.
_ORDINARY = r"!-~\x{a1}-\x{167f}"
ANY_SPACE = rf"[[^{_ORDINARY}]&&[{SPACE}]]"
INLINE_SPACE = rf"[[^{_ORDINARY}]&&[{INLINE}]]"
BREAK = rf"[[^ {_ORDINARY}]&&[{BREAKS}]]"
NO_BREAK = rf"[ {_ORDINARY}[^{BREAKS}]]"
LINE_END = rf"(?:\r\n|{BREAK})"
WHOLE_LINE = rf"{NO_BREAK}++{LINE_END}?|{LINE_END}"

# The same classes as plain characters, for trimming without a regular expression.
SPACE_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
BREAK_CHARS = "".join(c for c in SPACE_CHARS if len(f"a{c}b".splitlines()) == 2)
INLINE_CHARS = "".join(c for c in SPACE_CHARS if c not in BREAK_CHARS)
