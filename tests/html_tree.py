"""A plain tree walk for tests: all text nodes, and the text of every paragraph."""

from html.parser import HTMLParser

from docketline.functions.html_exact import RAW_TEXT_ELEMENTS, VOID_ELEMENTS


class Walker(HTMLParser):
    """Collects stripped text nodes, and the text of every <p> element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.nodes: list[str] = []
        self.paragraphs: list[list[str]] = []
        self.open_p: list[tuple[int, int]] = []   # (stack depth, paragraph no)

    def handle_starttag(self, tag, attrs):
        if tag in VOID_ELEMENTS:
            return
        self.stack.append(tag)
        if tag == "p":
            self.paragraphs.append([])
            self.open_p.append((len(self.stack), len(self.paragraphs) - 1))

    def handle_startendtag(self, tag, attrs):
        if tag == "p":
            self.paragraphs.append([])

    def handle_endtag(self, tag):
        if tag not in self.stack:
            return
        depth = len(self.stack) - 1 - self.stack[::-1].index(tag)
        del self.stack[depth:]
        self.open_p = [(d, i) for d, i in self.open_p if d <= depth]

    def handle_data(self, data):
        if self.stack and self.stack[-1] in RAW_TEXT_ELEMENTS:
            return
        s = data.strip()
        if not s:
            return
        self.nodes.append(s)
        for _, i in self.open_p:
            self.paragraphs[i].append(s)


def walk(doc: str | None) -> Walker:
    w = Walker()
    if doc:
        w.feed(doc)
        w.close()
    return w
