import ast
import glob
import os
import time

from pyspark.sql import functions as F

from shelfmark.functions.scripts import script_definitions
from shelfmark.operators.definitions import extract_definitions, last_per_line


def extract(spark, language, text):
    rows = spark.createDataFrame([(1, language, text)], "file_id long, language string, body string")
    found = extract_definitions(rows).orderBy("ordinal").collect()
    return [(r["name"], r["start_line"], r["end_line"], r["body"]) for r in found]


PYTHON = '''import os
def a(): pass
@deco
async def b(x,
   y):
    """doc
def fake():
    """
    def inner():
        pass
    return (1,
2)  # trailing

# comment
class C(object):
    """doc"""
    x = 1
    @property
    def m(self):
        return 1
    class D:
        def n(self): pass
    def k(self): return \\
 3
if x:
    def no(): pass
class E: pass
def last():
    return "é𝒳#"   # end
'''


def test_python(spark):
    assert extract(spark, "Python", PYTHON) == [
        ("a", 2, 2, "def a(): pass"),
        ("b", 4, 12, 'async def b(x,\n   y):\n    """doc\ndef fake():\n    """\n'
                     "    def inner():\n        pass\n    return (1,\n2)"),
        ("m", 19, 20, "def m(self):\n        return 1"),
        ("k", 23, 24, "def k(self): return \\\n 3"),
        ("last", 28, 29, 'def last():\n    return "é𝒳#"'),
    ]


def test_signature_checksum_and_empty_files(spark):
    rows = spark.createDataFrame(
        [(1, "Python", "def f(a,  \n  b):\n  pass\n"), (2, "Python", ""), (3, "Go", "func f() {}"),
         (4, "JavaScript", ""), (5, "JavaScript", "function f() {")],
        "file_id long, language string, body string",
    )
    (row,) = extract_definitions(rows).withColumn("again", F.sha2("body", 256)).collect()
    assert (row["file_id"], row["signature"], row["checksum"]) == (1, "def f(a,", row["again"])


def test_python_equals_ast(spark):
    texts, expected = [], {}
    for path in sorted(glob.glob(os.path.dirname(os.__file__) + "/*.py"))[:80]:
        with open(path, "rb") as file:
            text = file.read().decode("utf-8", errors="replace")
        if "\f" in text or "\r" in text:
            continue
        found = []
        for node in ast.parse(text).body:
            members = node.body if isinstance(node, ast.ClassDef) else [node]
            for member in members:
                if isinstance(member, ast.FunctionDef | ast.AsyncFunctionDef):
                    found.append((member.name, member.lineno, member.end_lineno,
                                  ast.get_source_segment(text, member)))
        expected[len(texts)] = found
        texts.append((len(texts), "Python", text))
    rows = spark.createDataFrame(texts, "file_id long, language string, body string").repartition(8)
    got = {number: [] for number in expected}
    for r in extract_definitions(rows).orderBy("file_id", "ordinal").collect():
        got[r["file_id"]].append((r["name"], r["start_line"], r["end_line"], r["body"]))
    assert got == expected


SCRIPT = '''// a comment { with brace
function a(x = {y: 1}) { return "}"; }
export function no() {}
const f = () => { if (x) { return `}`; } }
async function b() {
  // }
  function inner() { }
  return /[}]/.test(x);
}
function* gen() {}
class A extends B {
  x = 1
  constructor(a, {b}) { super(); }
  get v() { return this.x }
  static async *[Symbol.iterator]() {}
  h = () => { return 1 }
  "quoted"() { return 2 }
  #priv(
     a,
     b
  ) {
    return { a: 1 };
  }
}
export class X { m() {} }
foo(function() { function e() {} })
function z() {
}
'''


def test_javascript(spark):
    assert [d[:3] for d in extract(spark, "JavaScript", SCRIPT)] == [
        ("a", 2, 2), ("b", 5, 9), ("constructor", 13, 13), ("v", 14, 14), ("[Symbol.iterator]", 15, 15),
        ('"quoted"', 17, 17), ("#priv", 18, 23), ("z", 27, 28),
    ]
    bodies = {d[0]: d[3] for d in extract(spark, "JavaScript", SCRIPT)}
    assert bodies["a"] == 'function a(x = {y: 1}) { return "}"; }'
    assert bodies["[Symbol.iterator]"] == "static async *[Symbol.iterator]() {}"
    assert bodies["#priv"].endswith("return { a: 1 };\n  }")


TYPED = '''abstract class Q { m() {} }
@Comp()
class A<T extends {a: string}> {
  private name: {x: number} = {x: 1}
  @Input() foo(a: string): {b: number} { return {b: 1}; }
  public async bar<T>(x: T): Promise<void> {
  }
  abstract baz(): void;
}
function f(x: number): string;
function f(x: any): {a: string} {
  return x;
}
declare function dd(): void;
'''


def test_typescript(spark):
    assert extract(spark, "TypeScript", TYPED) == [
        ("foo", 5, 5, "foo(a: string): {b: number} { return {b: 1}; }"),
        ("bar", 6, 7, "public async bar<T>(x: T): Promise<void> {\n  }"),
        ("f", 11, 13, "function f(x: any): {a: string} {\n  return x;\n}"),
    ]


def test_last_definition_of_a_line_wins(spark):
    rows = spark.createDataFrame(
        [(1, "JavaScript", "function a(){} function b(){}\nfunction c(){}")],
        "file_id long, language string, body string",
    )
    kept = last_per_line(extract_definitions(rows)).collect()
    assert {(r["start_line"], r["name"]) for r in kept} == {(1, "b"), (2, "c")}


def test_decorators_of_any_length_and_depth(spark):
    long = "x" * 100000
    text = f"class A {{\n  @Doc('{long}')\n  run(a) {{ return 1 }}\n}}\n"
    assert extract(spark, "JavaScript", text) == [("run", 2, 3, f"@Doc('{long}')\n  run(a) {{ return 1 }}")]
    text = f"class A {{\n  @Doc(({'(' * 5000}{')' * 5000}))\n  run(a) {{ return 1 }}\n}}\n"
    assert extract(spark, "TypeScript", text) == [("run", 3, 3, "run(a) { return 1 }")]
    text = "class A {\n  @Doc(() => [of(f(1))])\n  run(a) { return 1 }\n}\n"
    assert extract(spark, "TypeScript", text) == [("run", 3, 3, "run(a) { return 1 }")]
    assert extract(spark, "TypeScript", "@Comp({p: [ref(f(1))]}) class A { run(a) { return 1 } }") == [
        ("run", 1, 1, "run(a) { return 1 }")]
    text = "class A {\n  @One()\n  @Two\n  static async run(a) { }\n  x = call()\n  next() { }\n}"
    assert extract(spark, "JavaScript", text) == [
        ("run", 2, 4, "@One()\n  @Two\n  static async run(a) { }"), ("next", 6, 6, "next() { }")]


def test_regular_expressions_after_many_blanks(spark):
    for blanks in ("", " " * 45, " " * 5000, "\n" * 100):
        text = f"function f() {{ x ={blanks}/}}/; return 1 }}"
        assert extract(spark, "JavaScript", text) == [("f", 1, 1 + blanks.count("\n"), text)]


def test_scripts_take_linear_time():
    def seconds(n):
        text = "".join(f"function f{i}(a, b = {{}}) {{\n  return '{{' + `x` + /[}}]/;\n}}\n" for i in range(n))
        began = time.process_time()
        assert len(script_definitions(text, "JavaScript")) == n
        return time.process_time() - began

    small = min(seconds(2000) for _ in range(3))
    assert min(seconds(8000) for _ in range(2)) < 8 * small
    assert script_definitions("class A {" + "x: {a: 1} | {b: 2}\n" * 20000 + "run() {} }", "TypeScript")[0]["name"] == "run"


def test_where_a_regular_expression_may_begin(spark):
    for inside in (
        "switch (s) { case /}/.test(s): return 1 }", "return typeof /{/", "if (s) /}/.test(s)",
        "if (a(b(s))) /}/.test(s); else /{/.exec(s)", "for (const x of /}/g) {}", "x = a /* { */ / 2 / 1", "y = b[1] / 2; z = '}' / 1",
        "return (a) / 2 + `}` / 3", "x = o.return / 2; y = '/'", "while (s) // {\n /}/.test(s)", "f(/[/}]}/, 1)",
    ):
        text = f"function f(s) {{ {inside} }}"
        after = "function g() {}"
        found = extract(spark, "JavaScript", f"{text}\n{after}")
        assert [d[0] for d in found] == ["f", "g"] and found[0][3] == text and found[1][3] == after, inside


def test_nested_template_literals(spark):
    for inside in ("`a${`b${c}}`}`", "`${ {a: `}`}.a }}`", "`'${x}'` + '`'", "`\\`${\"}\"}`", "`$ ${1}${`${2}`}{`", "`{${f(`{`)}`"):
        for text in (f"function f() {{ return {inside} }}", f"function f(x = {inside}) {{ }}"):
            found = extract(spark, "JavaScript", f"{text}\nconst t = {inside}\nfunction g() {{}}")
            assert [d[0] for d in found] == ["f", "g"] and found[0][3] == text, inside


def test_comments_before_a_method_take_linear_time():
    def seconds(n, filler):
        text = "class A {" + filler * n + "run() { return 1 }\n" + filler * n + "}"
        began = time.process_time()
        assert [d["name"] for d in script_definitions(text, "JavaScript")] == ["run"]
        return time.process_time() - began

    for filler in ("// a comment\n", "\n", "/* x */ ", "  \n\t"):
        small = max(min(seconds(16000, filler) for _ in range(3)), 0.01)
        assert min(seconds(32000, filler) for _ in range(3)) < 3 * small
