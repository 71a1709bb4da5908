"""Random small programs that use every statement form the flow rules know."""

import random

NAMES = ["a", "b", "c", "d"]


def expression(r, depth=0):
    pick = r.random()
    if pick < 0.45 or depth > 2:
        return r.choice(NAMES)
    if pick < 0.55:
        return str(r.randint(0, 99))
    if pick < 0.65:
        return f"{r.choice(['f', 'g', 'len', 'a.b', 'a.f', '(a or b)'])}({expression(r, depth + 1)})"
    if pick < 0.7:
        return f"[{r.choice(NAMES)} for {r.choice(NAMES)} in {expression(r, depth + 1)}]"
    if pick < 0.75:
        return f"(lambda {r.choice(NAMES)}: {expression(r, depth + 1)})"
    if pick < 0.8:
        return f"({r.choice(NAMES)} := {expression(r, depth + 1)})"
    return f"({expression(r, depth + 1)} + {expression(r, depth + 1)})"


def block(r, depth, pad, loop, func):
    lines = []
    for _ in range(r.randint(1, 4)):
        lines += statement(r, depth, pad, loop, func)
    return lines


def statement(r, depth, pad, loop, func):
    name, more = r.choice(NAMES), pad + "    "
    kinds = ["assign"] * 5 + ["aug", "expr", "expr", "del", "import", "pass"]
    if func:
        kinds += ["return", "raise"]
    if loop:
        kinds += ["break", "continue", "break"]
    if depth < 4:
        kinds += ["if", "if", "for", "while", "try", "try", "with", "match", "def", "class", "star"]
    kind = r.choice(kinds)
    inner = lambda l=loop, f=func: block(r, depth + 1, more, l, f)
    e = lambda: expression(r)
    match kind:
        case "assign":
            return [f"{pad}{name} = {e()}"]
        case "aug":
            return [f"{pad}{name} += {e()}"]
        case "expr":
            return [f"{pad}{e()}"]
        case "del":
            return [f"{pad}del {name}"]
        case "import":
            return [f"{pad}{r.choice(['import a.b', 'import x.y as c', 'from m import d', 'from m import n as a'])}"]
        case "pass" | "break" | "continue":
            return [f"{pad}{kind}"]
        case "return" | "raise":
            return [f"{pad}{kind} {e()}"]
        case "if":
            out = [f"{pad}if {e()}:", *inner()]
            if r.random() < 0.3:
                out += [f"{pad}elif {e()}:", *inner()]
            return out + ([f"{pad}else:", *inner()] if r.random() < 0.5 else [])
        case "for" | "while":
            head = f"{pad}for {name} in {e()}:" if kind == "for" else f"{pad}while {e()}:"
            return [head, *inner(True)] + ([f"{pad}else:", *inner()] if r.random() < 0.4 else [])
        case "with":
            return [f"{pad}with {e()} as {name}:", *inner()]
        case "try":
            handlers = r.randint(0, 2)
            out = [f"{pad}try:", *inner()]
            for _ in range(handlers):
                out += [f"{pad}except {r.choice(['E', 'a'])} as z:", *inner()]
            if handlers and r.random() < 0.4:
                out += [f"{pad}else:", *inner()]
            if not handlers or r.random() < 0.4:
                out += [f"{pad}finally:", *inner()]
            return out
        case "star":
            return [f"{pad}try:", *block(r, depth + 1, more, False, False), f"{pad}except* E:", *block(r, depth + 1, more, False, False)]
        case "match":
            out = [f"{pad}match {e()}:"]
            for i in range(r.randint(1, 3)):
                out += [f"{more}case {i}:", *block(r, depth + 1, more + "    ", loop, func)]
            return out
        case "def":
            args = r.choice(["", "a", "a, b=c", "*a, d=1", "a, /, b, *, c, **d"])
            return [f"{pad}@{r.choice(NAMES)}", f"{pad}{r.choice(['def', 'async def'])} {r.choice(['f', 'g', 'a'])}({args}):", *inner(False, True)]
        case "class":
            return [f"{pad}class {r.choice(['C', 'b'])}({r.choice(NAMES)}):", *inner(False, False)]


def program(seed):
    r = random.Random(seed)
    return "\n".join(block(r, 0, "", False, False)) + "\n"
