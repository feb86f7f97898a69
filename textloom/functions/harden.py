"""Programs that run a solution against tests: main guards out, every assertion counted, early exits blocked."""

from __future__ import annotations

import ast
from functools import reduce

COUNTER, COUNTED = "__asserts_seen", "__count_assert"


def _is_main_guard(test: ast.expr) -> bool:
    if not (isinstance(test, ast.Compare) and len(test.ops) == 1 and isinstance(test.ops[0], ast.Eq)):
        return False
    sides = [("name", x.id) if isinstance(x, ast.Name) else ("text", x.value) if isinstance(x, ast.Constant) else None for x in (test.left, test.comparators[0])]
    return None not in sides and sorted(map(str, sides)) == sorted(map(str, [("name", "__name__"), ("text", "__main__")]))


def _suites(node: ast.AST):
    """(field, statements) of each block that a node holds."""
    for field, value in ast.iter_fields(node):
        if isinstance(value, list) and value and isinstance(value[0], ast.stmt):
            yield field, value


def _children(node: ast.AST):
    """Statements and the nodes that hold some (handlers, cases) below a node."""
    for child in ast.iter_child_nodes(node):
        if isinstance(child, (ast.stmt, ast.excepthandler, ast.match_case)):
            yield child


def strip_main_guard(source: str) -> str:
    """The program without ``if __name__ == "__main__"`` at any depth; what stands in ``else`` stays."""
    tree = ast.parse(source)

    def clean(node: ast.AST) -> None:
        for child in _children(node):
            clean(child)
        for field, body in list(_suites(node)):
            new = [y for x in body for y in (x.orelse if isinstance(x, ast.If) and _is_main_guard(x.test) else [x])]
            if not new and field == "body" and not isinstance(node, ast.Module):
                new = [ast.Pass()]
            setattr(node, field, new)

    clean(tree)
    return ast.unparse(ast.fix_missing_locations(tree))


def _whole_number(node: ast.expr) -> int | None:
    try:
        value = ast.literal_eval(node)
    except (ValueError, TypeError, SyntaxError):
        return None
    plain = isinstance(node, ast.Constant) or isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.UAdd, ast.USub)) and isinstance(node.operand, ast.Constant)
    return int(value) if plain and isinstance(value, int) else None


def static_length(node: ast.expr) -> int | None:
    """How often a loop over an expression turns, where its text says so: range of literals, enumerate, displays."""
    if isinstance(node, (ast.List, ast.Tuple, ast.Set)):
        return len(node.elts)
    if isinstance(node, ast.Dict):
        return len(node.keys)
    if not (isinstance(node, ast.Call) and isinstance(node.func, ast.Name)):
        return None
    if node.func.id == "enumerate":
        return static_length(node.args[0]) if node.args else None
    if node.func.id == "range":
        numbers = [_whole_number(a) for a in node.args]
        if None not in numbers and 1 <= len(numbers) <= 3 and (len(numbers) < 3 or numbers[2]):
            return len(range(*numbers))
    return None


def count_asserts(source: str) -> tuple[str, int]:
    """(program that calls the counter before each assertion, how many run). Loops whose turns aren't known raise ValueError."""
    tree = ast.parse(source)
    call = f"{COUNTED}()"

    def walk(node: ast.AST, times: int) -> int:
        total = 0
        if isinstance(node, ast.AsyncFor):
            raise ValueError("asynchronous loops can't be counted")
        turns = 1
        if isinstance(node, ast.For):
            turns = static_length(node.iter)
            if turns is None:
                raise ValueError(f"line {node.lineno}: the turns of this loop can't be counted")
        for field, body in _suites(node):
            inner = times * (turns if field == "body" else 1)
            total += sum(inner if isinstance(x, ast.Assert) else walk(x, inner) for x in body)
            setattr(node, field, [y for x in body for y in ([ast.parse(call).body[0], x] if isinstance(x, ast.Assert) else [x])])
        holders = [c for c in ast.iter_child_nodes(node) if isinstance(c, (ast.excepthandler, ast.match_case))]
        return total + sum(walk(c, times) for c in holders)

    n = walk(tree, 1)
    return ast.unparse(ast.fix_missing_locations(tree)), n


#: Ends a program early in no way that exits as if all were well.
GUARD = '''\
import builtins as _b, os as _o, signal as _s, sys as _y

def _refuse(*_args, **_kwargs):
    raise RuntimeError("ending the program early is not allowed")

_b.exit = _b.quit = _y.exit = _o._exit = _o.abort = _refuse
try:
    import posix as _p
    _p._exit = _p.abort = _refuse
except ImportError:
    pass
_send = getattr(_o, "kill", None)
if _send:
    def _kill(pid, sig, _send=_send, _me=_o.getpid()):
        return _refuse() if pid in (_me, 0, -1) else _send(pid, sig)
    _o.kill = _kill
    _s.raise_signal = _refuse
'''


def program(solution: str, imports: str, tests: str) -> str:
    """Guard, imports, solution, counted tests, and a check that each assertion has run as often as the text says."""
    counted, n = count_asserts(tests)
    parts = [
        GUARD,
        imports,
        strip_main_guard(solution),
        f"{COUNTER} = [0]\n\ndef {COUNTED}():\n    {COUNTER}[0] += 1\n",
        counted,
        f"if {COUNTER}[0] != {n}:\n    raise AssertionError(f'{{{COUNTER}[0]}} of {n} assertions ran')\n",
    ]
    return reduce(lambda a, b: f"{a}\n{b}", parts)
