"""A page read token by token in plain Python: what the page plan's content and links are compared with."""

import re

from webloom.functions.constants import ATTR_NAME_RE, ATTR_RE, ATTR_VALUE_RE, BLOCK_TAGS, HEADING_LEVELS, SKIP_TAGS, TOKEN_RE

SPACES = "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def py(pattern):
    return re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\u{int(m[1], 16):04x}", pattern)


ATTR, NAME, VALUE = (re.compile(py(p)) for p in (ATTR_RE, ATTR_NAME_RE, ATTR_VALUE_RE))


def tidy(text):
    text = re.sub(r" *\n *", "\n", re.sub("[ \t\f\x0b]+", " ", text))
    return re.sub(r"\n{3,}", "\n\n", text).strip(SPACES)


def attribute(tag, name):
    found = [a for a in ATTR.findall(tag) if NAME.match(a)[1].lower() == name]
    got = VALUE.match(found[-1]) if found else None
    return "".join(g or "" for g in got.groups()) if got else ""


class Page:
    """Output so far, with the two flags and the two depths that decide what a token does."""

    def __init__(self, markdown):
        self.markdown, self.out, self.links = markdown, "", []
        self.hidden = self.verbatim = 0
        self.link = self.bullet = None
        self.fresh_line = False

    def end_link(self):
        if self.link is None:
            return
        (href, words), self.link = self.link, None
        label = " ".join(" ".join(words).split(None)) if words else ""
        if href:
            self.links.append((label, href))
        self.out += f"[{label}]({href})" if href and self.markdown else label

    def new_line(self):
        if self.fresh_line or self.verbatim:
            return
        self.end_link()
        self.out = self.out.rstrip(" \t")
        self.out += "" if self.out.endswith("\n") else "\n"
        self.fresh_line, self.bullet = True, None

    def say(self, text):
        if self.verbatim:
            self.out += text
        elif tidy(text) and self.link is not None:
            self.link[1].append(tidy(text))
        elif tidy(text):
            self.out += self.bullet + tidy(text) if self.bullet else tidy(text) + " "
            self.bullet, self.fresh_line = None, False

    def opened(self, name, tag):
        if name == "a":
            self.end_link()
            self.link = (attribute(tag, "href"), [])
        elif name == "img":
            self.end_link()
            alt, src = attribute(tag, "alt").strip(SPACES), attribute(tag, "src")
            self.out += f"![{alt}]({src}) " if self.markdown and src else alt + " " if alt else ""
        elif name in ("br", "hr"):
            self.new_line()
            self.out += ("---\n" if self.markdown else "\n") if name == "hr" else ""
        elif name in ("pre", "code"):
            self.verbatim += 1
            if name == "pre":
                self.end_link()
                self.out += "```\n" if self.markdown else ""
        elif name in SKIP_TAGS:
            self.hidden += 1
        elif name in ("li", *HEADING_LEVELS, *BLOCK_TAGS):
            self.end_link()
            self.new_line()
            if name == "li":
                self.bullet = "- " if self.markdown else None
            elif self.markdown:
                self.out += "#" * HEADING_LEVELS[name] + " " if name in HEADING_LEVELS else ""

    def closed(self, name):
        if name in ("pre", "code"):
            self.verbatim = max(0, self.verbatim - 1)
        if name == "pre":
            self.end_link()
            self.out = self.out.rstrip(" \t")
            self.out += "\n```" if self.markdown and not self.out.endswith("```\n") else ""
            self.new_line()
        elif name in SKIP_TAGS:
            self.hidden = max(0, self.hidden - 1)
        elif name in ("a", "li", *HEADING_LEVELS, *BLOCK_TAGS):
            self.end_link()
            if name != "a":
                self.new_line()


def read(page, markdown=True):
    """(content, [(label, href)]) of a page without entities."""
    p, in_title = Page(markdown), False
    for tok in re.findall(TOKEN_RE, page):
        tag = re.match(r"<(/?)([a-zA-Z][a-zA-Z0-9-]*)", tok)
        if not tok.startswith("<"):
            if not in_title and not p.hidden:
                p.say(tok)
        elif tag and not tok.startswith("<!--"):
            name = tag[2].lower()
            if name == "title" and (in_title or not tag[1]):
                in_title = not tag[1]
            elif not in_title:
                p.closed(name) if tag[1] else p.opened(name, tok)
    p.end_link()
    text = re.sub(r"\]\(([^)]*)\)[%s]+(?=.)" % SPACES, r"](\1) ", tidy(p.out), flags=re.S)
    text = re.sub(r" *\n *", "\n", re.sub(" {2,}", " ", text))
    return re.sub(r"\n{3,}", "\n\n", text).strip(SPACES), p.links
