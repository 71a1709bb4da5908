"""Expected graphs of the template sources, written out once by the brute-force reading in tests/bruteforce.py.

Node lines: path|type|line|column|end line|end column|name|value, `+k` adding the number of digits of
the row key and `{K}` standing for the key. Edge lines: kind|source|target|discriminator|resolved.
"""

NODES = {
    0: r"""
$|Module|0|0|0|0||
$.body[0]|Assign|1|0|1|8+k||
$.body[0].targets[0]|Name|1|0|1|5|limit|
$.body[0].targets[0].ctx|Store|0|0|0|0||
$.body[0].value|Constant|1|8|1|8+k||{K}
""",
    1: r"""
$|Module|0|0|0|0||
$.body[0]|FunctionDef|1|0|4|15|scale|
$.body[0].args|arguments|0|0|0|0||
$.body[0].args.args[0]|arg|1|10|1|14|base|
$.body[0].body[0]|If|2|4|3|22+k||
$.body[0].body[0].test|Compare|2|7|2|14+k||
$.body[0].body[0].test.left|Name|2|7|2|11|base|
$.body[0].body[0].test.left.ctx|Load|0|0|0|0||
$.body[0].body[0].test.ops[0]|Lt|0|0|0|0||
$.body[0].body[0].test.comparators[0]|Constant|2|14|2|14+k||{K}
$.body[0].body[0].body[0]|Return|3|8|3|22+k||
$.body[0].body[0].body[0].value|BinOp|3|15|3|22+k||
$.body[0].body[0].body[0].value.left|Name|3|15|3|19|base|
$.body[0].body[0].body[0].value.left.ctx|Load|0|0|0|0||
$.body[0].body[0].body[0].value.op|Add|0|0|0|0||Add
$.body[0].body[0].body[0].value.right|Constant|3|22|3|22+k||{K}
$.body[0].body[1]|Return|4|4|4|15||
$.body[0].body[1].value|Name|4|11|4|15|base|
$.body[0].body[1].value.ctx|Load|0|0|0|0||
""",
    2: r"""
$|Module|0|0|0|0||
$.body[0]|Import|1|0|1|14||
$.body[0].names[0]|alias|1|7|1|14|os.path|
$.body[1]|ImportFrom|2|0|2|32|json|
$.body[1].names[0]|alias|2|17|2|32|dumps|
$.body[2]|FunctionDef|5|0|13|16|tally|
$.body[2].args|arguments|0|0|0|0||
$.body[2].args.args[0]|arg|5|10|5|14|rows|
$.body[2].args.args[1]|arg|5|16|5|21|start|
$.body[2].args.defaults[0]|Constant|5|22|5|23||0
$.body[2].body[0]|Assign|6|4|6|17||
$.body[2].body[0].targets[0]|Name|6|4|6|9|count|
$.body[2].body[0].targets[0].ctx|Store|0|0|0|0||
$.body[2].body[0].value|Name|6|12|6|17|start|
$.body[2].body[0].value.ctx|Load|0|0|0|0||
$.body[2].body[1]|For|7|4|12|29||
$.body[2].body[1].target|Name|7|8|7|11|row|
$.body[2].body[1].target.ctx|Store|0|0|0|0||
$.body[2].body[1].iter|Name|7|15|7|19|rows|
$.body[2].body[1].iter.ctx|Load|0|0|0|0||
$.body[2].body[1].body[0]|If|8|8|9|20||
$.body[2].body[1].body[0].test|UnaryOp|8|11|8|18||
$.body[2].body[1].body[0].test.op|Not|0|0|0|0||
$.body[2].body[1].body[0].test.operand|Name|8|15|8|18|row|
$.body[2].body[1].body[0].test.operand.ctx|Load|0|0|0|0||
$.body[2].body[1].body[0].body[0]|Continue|9|12|9|20||
$.body[2].body[1].body[1]|AugAssign|10|8|10|25||
$.body[2].body[1].body[1].target|Name|10|8|10|13|count|
$.body[2].body[1].body[1].target.ctx|Store|0|0|0|0||
$.body[2].body[1].body[1].op|Add|0|0|0|0||Add
$.body[2].body[1].body[1].value|Call|10|17|10|25||
$.body[2].body[1].body[1].value.func|Name|10|17|10|20|len|
$.body[2].body[1].body[1].value.func.ctx|Load|0|0|0|0||
$.body[2].body[1].body[1].value.args[0]|Name|10|21|10|24|row|
$.body[2].body[1].body[1].value.args[0].ctx|Load|0|0|0|0||
$.body[2].body[1].orelse[0]|Assign|12|8|12|29||
$.body[2].body[1].orelse[0].targets[0]|Name|12|8|12|13|count|
$.body[2].body[1].orelse[0].targets[0].ctx|Store|0|0|0|0||
$.body[2].body[1].orelse[0].value|Call|12|16|12|29||
$.body[2].body[1].orelse[0].value.func|Name|12|16|12|22|helper|
$.body[2].body[1].orelse[0].value.func.ctx|Load|0|0|0|0||
$.body[2].body[1].orelse[0].value.args[0]|Name|12|23|12|28|count|
$.body[2].body[1].orelse[0].value.args[0].ctx|Load|0|0|0|0||
$.body[2].body[2]|Return|13|4|13|16||
$.body[2].body[2].value|Name|13|11|13|16|count|
$.body[2].body[2].value.ctx|Load|0|0|0|0||
$.body[3]|AsyncFunctionDef|16|0|21|34|helper|
$.body[3].args|arguments|0|0|0|0||
$.body[3].args.args[0]|arg|16|17|16|18|n|
$.body[3].body[0]|While|17|4|20|17||
$.body[3].body[0].test|Compare|17|10|17|14+k||
$.body[3].body[0].test.left|Name|17|10|17|11|n|
$.body[3].body[0].test.left.ctx|Load|0|0|0|0||
$.body[3].body[0].test.ops[0]|Gt|0|0|0|0||
$.body[3].body[0].test.comparators[0]|Constant|17|14|17|14+k||{K}
$.body[3].body[0].body[0]|Assign|18|8|18|17||
$.body[3].body[0].body[0].targets[0]|Name|18|8|18|9|n|
$.body[3].body[0].body[0].targets[0].ctx|Store|0|0|0|0||
$.body[3].body[0].body[0].value|BinOp|18|12|18|17||
$.body[3].body[0].body[0].value.left|Name|18|12|18|13|n|
$.body[3].body[0].body[0].value.left.ctx|Load|0|0|0|0||
$.body[3].body[0].body[0].value.op|Sub|0|0|0|0||Sub
$.body[3].body[0].body[0].value.right|Constant|18|16|18|17||1
$.body[3].body[0].body[1]|If|19|8|20|17||
$.body[3].body[0].body[1].test|Compare|19|11|19|17||
$.body[3].body[0].body[1].test.left|Name|19|11|19|12|n|
$.body[3].body[0].body[1].test.left.ctx|Load|0|0|0|0||
$.body[3].body[0].body[1].test.ops[0]|Eq|0|0|0|0||
$.body[3].body[0].body[1].test.comparators[0]|Constant|19|16|19|17||7
$.body[3].body[0].body[1].body[0]|Break|20|12|20|17||
$.body[3].body[1]|Return|21|4|21|34||
$.body[3].body[1].value|Call|21|11|21|34||
$.body[3].body[1].value.func|Attribute|21|11|21|23||
$.body[3].body[1].value.func.value|Attribute|21|11|21|18||
$.body[3].body[1].value.func.value.value|Name|21|11|21|13|os|
$.body[3].body[1].value.func.value.value.ctx|Load|0|0|0|0||
$.body[3].body[1].value.func.value.ctx|Load|0|0|0|0||
$.body[3].body[1].value.func.ctx|Load|0|0|0|0||
$.body[3].body[1].value.args[0]|Call|21|24|21|33||
$.body[3].body[1].value.args[0].func|Name|21|24|21|30|encode|
$.body[3].body[1].value.args[0].func.ctx|Load|0|0|0|0||
$.body[3].body[1].value.args[0].args[0]|Name|21|31|21|32|n|
$.body[3].body[1].value.args[0].args[0].ctx|Load|0|0|0|0||
""",
    4: r"""
$|Module|0|0|0|0||
$.body[0]|ClassDef|1|0|30|36|Box|
$.body[0].body[0]|Assign|2|4|2|11+k||
$.body[0].body[0].targets[0]|Name|2|4|2|8|size|
$.body[0].body[0].targets[0].ctx|Store|0|0|0|0||
$.body[0].body[0].value|Constant|2|11|2|11+k||{K}
$.body[0].body[1]|FunctionDef|5|4|30|36|pick|
$.body[0].body[1].args|arguments|0|0|0|0||
$.body[0].body[1].args.args[0]|arg|5|13|5|18|items|
$.body[0].body[1].args.vararg|arg|5|21|5|25|rest|
$.body[0].body[1].args.kwonlyargs[0]|arg|5|27|5|30|key|
$.body[0].body[1].args.kw_defaults[0]|Constant|5|31|5|35||None
$.body[0].body[1].body[0]|While|6|8|18|19||
$.body[0].body[1].body[0].test|Name|6|14|6|19|items|
$.body[0].body[1].body[0].test.ctx|Load|0|0|0|0||
$.body[0].body[1].body[0].body[0]|Try|7|12|16|26||
$.body[0].body[1].body[0].body[0].body[0]|Assign|8|16|8|34||
$.body[0].body[1].body[0].body[0].body[0].targets[0]|Name|8|16|8|20|item|
$.body[0].body[1].body[0].body[0].body[0].targets[0].ctx|Store|0|0|0|0||
$.body[0].body[1].body[0].body[0].body[0].value|Call|8|23|8|34||
$.body[0].body[1].body[0].body[0].body[0].value.func|Attribute|8|23|8|32||
$.body[0].body[1].body[0].body[0].body[0].value.func.value|Name|8|23|8|28|items|
$.body[0].body[1].body[0].body[0].body[0].value.func.value.ctx|Load|0|0|0|0||
$.body[0].body[1].body[0].body[0].body[0].value.func.ctx|Load|0|0|0|0||
$.body[0].body[1].body[0].body[0].body[1]|If|9|16|10|25||
$.body[0].body[1].body[0].body[0].body[1].test|Compare|9|19|9|31||
$.body[0].body[1].body[0].body[0].body[1].test.left|Name|9|19|9|23|item|
$.body[0].body[1].body[0].body[0].body[1].test.left.ctx|Load|0|0|0|0||
$.body[0].body[1].body[0].body[0].body[1].test.ops[0]|Is|0|0|0|0||
$.body[0].body[1].body[0].body[0].body[1].test.comparators[0]|Constant|9|27|9|31||None
$.body[0].body[1].body[0].body[0].body[1].body[0]|Break|10|20|10|25||
$.body[0].body[1].body[0].body[0].handlers[0]|ExceptHandler|11|12|12|24||
$.body[0].body[1].body[0].body[0].handlers[0].type|Name|11|19|11|27|KeyError|
$.body[0].body[1].body[0].body[0].handlers[0].type.ctx|Load|0|0|0|0||
$.body[0].body[1].body[0].body[0].handlers[0].body[0]|Continue|12|16|12|24||
$.body[0].body[1].body[0].body[0].orelse[0]|Assign|14|16|14|33||
$.body[0].body[1].body[0].body[0].orelse[0].targets[0]|Name|14|16|14|20|rest|
$.body[0].body[1].body[0].body[0].orelse[0].targets[0].ctx|Store|0|0|0|0||
$.body[0].body[1].body[0].body[0].orelse[0].value|Tuple|14|23|14|33||
$.body[0].body[1].body[0].body[0].orelse[0].value.elts[0]|Name|14|23|14|27|rest|
$.body[0].body[1].body[0].body[0].orelse[0].value.elts[0].ctx|Load|0|0|0|0||
$.body[0].body[1].body[0].body[0].orelse[0].value.elts[1]|Name|14|29|14|33|item|
$.body[0].body[1].body[0].body[0].orelse[0].value.elts[1].ctx|Load|0|0|0|0||
$.body[0].body[1].body[0].body[0].orelse[0].value.ctx|Load|0|0|0|0||
$.body[0].body[1].body[0].body[0].finalbody[0]|Assign|16|16|16|26||
$.body[0].body[1].body[0].body[0].finalbody[0].targets[0]|Name|16|16|16|19|key|
$.body[0].body[1].body[0].body[0].finalbody[0].targets[0].ctx|Store|0|0|0|0||
$.body[0].body[1].body[0].body[0].finalbody[0].value|Name|16|22|16|26|rest|
$.body[0].body[1].body[0].body[0].finalbody[0].value.ctx|Load|0|0|0|0||
$.body[0].body[1].body[0].orelse[0]|Delete|18|12|18|19||
$.body[0].body[1].body[0].orelse[0].targets[0]|Name|18|16|18|19|key|
$.body[0].body[1].body[0].orelse[0].targets[0].ctx|Del|0|0|0|0||
$.body[0].body[1].body[1]|With|19|8|24|54||
$.body[0].body[1].body[1].items[0]|withitem|0|0|0|0||
$.body[0].body[1].body[1].items[0].context_expr|Name|19|13|19|17|rest|
$.body[0].body[1].body[1].items[0].context_expr.ctx|Load|0|0|0|0||
$.body[0].body[1].body[1].items[0].optional_vars|Name|19|21|19|23|fh|
$.body[0].body[1].body[1].items[0].optional_vars.ctx|Store|0|0|0|0||
$.body[0].body[1].body[1].body[0]|Match|20|12|24|54||
$.body[0].body[1].body[1].body[0].subject|Name|20|18|20|21|key|
$.body[0].body[1].body[1].body[0].subject.ctx|Load|0|0|0|0||
$.body[0].body[1].body[1].body[0].cases[0]|match_case|0|0|0|0||
$.body[0].body[1].body[1].body[0].cases[0].pattern|MatchValue|21|21|21|22||
$.body[0].body[1].body[1].body[0].cases[0].pattern.value|Constant|21|21|21|22||0
$.body[0].body[1].body[1].body[0].cases[0].body[0]|Return|22|20|22|29||
$.body[0].body[1].body[1].body[0].cases[0].body[0].value|Name|22|27|22|29|fh|
$.body[0].body[1].body[1].body[0].cases[0].body[0].value.ctx|Load|0|0|0|0||
$.body[0].body[1].body[1].body[0].cases[1]|match_case|0|0|0|0||
$.body[0].body[1].body[1].body[0].cases[1].pattern|MatchAs|23|21|23|22||
$.body[0].body[1].body[1].body[0].cases[1].body[0]|Assign|24|20|24|54||
$.body[0].body[1].body[1].body[0].cases[1].body[0].targets[0]|Name|24|20|24|24|rest|
$.body[0].body[1].body[1].body[0].cases[1].body[0].targets[0].ctx|Store|0|0|0|0||
$.body[0].body[1].body[1].body[0].cases[1].body[0].value|ListComp|24|27|24|54||
$.body[0].body[1].body[1].body[0].cases[1].body[0].value.elt|Name|24|28|24|29|v|
$.body[0].body[1].body[1].body[0].cases[1].body[0].value.elt.ctx|Load|0|0|0|0||
$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0]|comprehension|0|0|0|0||
$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].target|Name|24|34|24|35|v|
$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].target.ctx|Store|0|0|0|0||
$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].iter|Name|24|39|24|41|fh|
$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].iter.ctx|Load|0|0|0|0||
$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].ifs[0]|NamedExpr|24|46|24|52||
$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].ifs[0].target|Name|24|46|24|47|w|
$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].ifs[0].target.ctx|Store|0|0|0|0||
$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].ifs[0].value|Name|24|51|24|52|v|
$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].ifs[0].value.ctx|Load|0|0|0|0||
$.body[0].body[1].body[2]|TryStar|25|8|29|32||
$.body[0].body[1].body[2].body[0]|Raise|26|12|26|24+k||
$.body[0].body[1].body[2].body[0].exc|Call|26|18|26|24+k||
$.body[0].body[1].body[2].body[0].exc.func|Name|26|18|26|22|size|
$.body[0].body[1].body[2].body[0].exc.func.ctx|Load|0|0|0|0||
$.body[0].body[1].body[2].body[0].exc.args[0]|Constant|26|23|26|23+k||{K}
$.body[0].body[1].body[2].body[1]|Assign|27|12|27|20||
$.body[0].body[1].body[2].body[1].targets[0]|Name|27|12|27|16|rest|
$.body[0].body[1].body[2].body[1].targets[0].ctx|Store|0|0|0|0||
$.body[0].body[1].body[2].body[1].value|Name|27|19|27|20|w|
$.body[0].body[1].body[2].body[1].value.ctx|Load|0|0|0|0||
$.body[0].body[1].body[2].handlers[0]|ExceptHandler|28|8|29|32||
$.body[0].body[1].body[2].handlers[0].type|Name|28|16|28|23|OSError|
$.body[0].body[1].body[2].handlers[0].type.ctx|Load|0|0|0|0||
$.body[0].body[1].body[2].handlers[0].body[0]|Assign|29|12|29|32||
$.body[0].body[1].body[2].handlers[0].body[0].targets[0]|Name|29|12|29|15|key|
$.body[0].body[1].body[2].handlers[0].body[0].targets[0].ctx|Store|0|0|0|0||
$.body[0].body[1].body[2].handlers[0].body[0].value|Lambda|29|18|29|32||
$.body[0].body[1].body[2].handlers[0].body[0].value.args|arguments|0|0|0|0||
$.body[0].body[1].body[2].handlers[0].body[0].value.args.args[0]|arg|29|25|29|26|v|
$.body[0].body[1].body[2].handlers[0].body[0].value.body|Name|29|28|29|32|rest|
$.body[0].body[1].body[2].handlers[0].body[0].value.body.ctx|Load|0|0|0|0||
$.body[0].body[1].body[3]|Return|30|8|30|36||
$.body[0].body[1].body[3].value|Call|30|15|30|36||
$.body[0].body[1].body[3].value.func|Name|30|15|30|21|sorted|
$.body[0].body[1].body[3].value.func.ctx|Load|0|0|0|0||
$.body[0].body[1].body[3].value.args[0]|Name|30|22|30|26|rest|
$.body[0].body[1].body[3].value.args[0].ctx|Load|0|0|0|0||
$.body[0].body[1].body[3].value.keywords[0]|keyword|30|28|30|35|key|
$.body[0].body[1].body[3].value.keywords[0].value|Name|30|32|30|35|key|
$.body[0].body[1].body[3].value.keywords[0].value.ctx|Load|0|0|0|0||
$.body[0].body[1].decorator_list[0]|Name|4|5|4|9|wrap|
$.body[0].body[1].decorator_list[0].ctx|Load|0|0|0|0||
""",
}

EDGES = {
    0: r"""
CFG|$.body[0]|$.__exit__|next|true
CFG|$.__entry__|$.body[0]|scope-entry|true
""",
    1: r"""
CFG|$.body[0]|$.__exit__|next|true
CFG|$.__entry__|$.body[0]|scope-entry|true
CFG|$.body[0].body[1]|$.body[0].__exit__|return|true
CFG|$.body[0].body[0].body[0]|$.body[0].__exit__|return|true
CFG|$.body[0].body[0]|$.body[0].body[0].body[0]|if-true|true
CFG|$.body[0].body[0]|$.body[0].body[1]|if-false|true
CFG|$.body[0].__entry__|$.body[0].body[0]|scope-entry|true
DFG|$.body[0].args.args[0]|$.body[0].body[0].test.left|base|true
DFG|$.body[0].args.args[0]|$.body[0].body[0].body[0].value.left|base|true
DFG|$.body[0].args.args[0]|$.body[0].body[1].value|base|true
""",
    2: r"""
CFG|$.body[3]|$.__exit__|next|true
CFG|$.body[2]|$.body[3]|next|true
CFG|$.body[1]|$.body[2]|next|true
CFG|$.body[0]|$.body[1]|next|true
CFG|$.__entry__|$.body[0]|scope-entry|true
CFG|$.body[2].body[2]|$.body[2].__exit__|return|true
CFG|$.body[2].body[1].orelse[0]|$.body[2].body[2]|next|true
CFG|$.body[2].body[1]|$.body[2].body[1].orelse[0]|loop-exit|true
CFG|$.body[2].body[1].body[1]|$.body[2].body[1]|next|true
CFG|$.body[2].body[1].body[0].body[0]|$.body[2].body[1]|continue|true
CFG|$.body[2].body[1].body[0]|$.body[2].body[1].body[0].body[0]|if-true|true
CFG|$.body[2].body[1].body[0]|$.body[2].body[1].body[1]|if-false|true
CFG|$.body[2].body[1]|$.body[2].body[1].body[0]|loop-body|true
CFG|$.body[2].body[0]|$.body[2].body[1]|next|true
CFG|$.body[2].__entry__|$.body[2].body[0]|scope-entry|true
DFG|$.body[2].args.args[1]|$.body[2].body[0].value|start|true
DFG|$.body[2].args.args[0]|$.body[2].body[1].iter|rows|true
DFG|$.body[2].body[1].target|$.body[2].body[1].body[0].test.operand|row|true
DFG|$.body[2].__external__.dfg:len|$.body[2].body[1].body[1].value.func|len|false
DFG|$.body[2].body[1].target|$.body[2].body[1].body[1].value.args[0]|row|true
DFG|$.body[2].__external__.dfg:helper|$.body[2].body[1].orelse[0].value.func|helper|false
DFG|$.body[2].body[0].targets[0]|$.body[2].body[1].orelse[0].value.args[0]|count|true
DFG|$.body[2].body[1].orelse[0].targets[0]|$.body[2].body[1].orelse[0].value.args[0]|count|true
DFG|$.body[2].body[1].body[1].target|$.body[2].body[1].orelse[0].value.args[0]|count|true
DFG|$.body[2].body[1].orelse[0].targets[0]|$.body[2].body[2].value|count|true
CFG|$.body[3].body[1]|$.body[3].__exit__|return|true
CFG|$.body[3].body[0]|$.body[3].body[1]|loop-exit|true
CFG|$.body[3].body[0].body[1].body[0]|$.body[3].body[1]|break|true
CFG|$.body[3].body[0].body[1]|$.body[3].body[0].body[1].body[0]|if-true|true
CFG|$.body[3].body[0].body[1]|$.body[3].body[0]|if-false|true
CFG|$.body[3].body[0].body[0]|$.body[3].body[0].body[1]|next|true
CFG|$.body[3].body[0]|$.body[3].body[0].body[0]|loop-body|true
CFG|$.body[3].__entry__|$.body[3].body[0]|scope-entry|true
DFG|$.body[3].args.args[0]|$.body[3].body[0].test.left|n|true
DFG|$.body[3].body[0].body[0].targets[0]|$.body[3].body[0].test.left|n|true
DFG|$.body[3].args.args[0]|$.body[3].body[0].body[0].value.left|n|true
DFG|$.body[3].body[0].body[0].targets[0]|$.body[3].body[0].body[0].value.left|n|true
DFG|$.body[3].args.args[0]|$.body[3].body[0].body[1].test.left|n|true
DFG|$.body[3].body[0].body[0].targets[0]|$.body[3].body[0].body[1].test.left|n|true
DFG|$.body[3].__external__.dfg:os|$.body[3].body[1].value.func.value.value|os|false
DFG|$.body[3].__external__.dfg:encode|$.body[3].body[1].value.args[0].func|encode|false
DFG|$.body[3].body[0].body[0].targets[0]|$.body[3].body[1].value.args[0].args[0]|n|true
CALL|$.body[2].body[1].body[1].value|$.__external__.call:len|len|false
CALL|$.body[2].body[1].orelse[0].value|$.body[3]|helper|true
CALL|$.body[3].body[1].value|$.__external__.call:os.path.join|os.path.join|false
CALL|$.body[3].body[1].value.args[0]|$.__external__.call:encode|encode|false
""",
    4: r"""
CFG|$.body[0]|$.__exit__|next|true
CFG|$.__entry__|$.body[0]|scope-entry|true
CFG|$.body[0].body[1]|$.body[0].__exit__|next|true
CFG|$.body[0].body[0]|$.body[0].body[1]|next|true
CFG|$.body[0].__entry__|$.body[0].body[0]|scope-entry|true
CFG|$.body[0].body[1].body[3]|$.body[0].body[1].__exit__|return|true
CFG|$.body[0].body[1].body[2]|$.body[0].body[1].body[3]|next|true
CFG|$.body[0].body[1].body[1].body[0].cases[0].body[0]|$.body[0].body[1].__exit__|return|true
CFG|$.body[0].body[1].body[1].body[0]|$.body[0].body[1].body[1].body[0].cases[0].body[0]|match-case-0|true
CFG|$.body[0].body[1].body[1].body[0].cases[1].body[0]|$.body[0].body[1].body[2]|next|true
CFG|$.body[0].body[1].body[1].body[0]|$.body[0].body[1].body[1].body[0].cases[1].body[0]|match-case-1|true
CFG|$.body[0].body[1].body[1]|$.body[0].body[1].body[1].body[0]|with-body|true
CFG|$.body[0].body[1].body[0].orelse[0]|$.body[0].body[1].body[1]|next|true
CFG|$.body[0].body[1].body[0]|$.body[0].body[1].body[0].orelse[0]|loop-exit|true
CFG|$.body[0].body[1].body[0].body[0].finalbody[0]|$.body[0].body[1].body[0]|next|true
CFG|$.body[0].body[1].body[0].body[0].orelse[0]|$.body[0].body[1].body[0].body[0].finalbody[0]|next|true
CFG|$.body[0].body[1].body[0].body[0].body[1].body[0]|$.body[0].body[1].body[1]|break|true
CFG|$.body[0].body[1].body[0].body[0].body[1]|$.body[0].body[1].body[0].body[0].body[1].body[0]|if-true|true
CFG|$.body[0].body[1].body[0].body[0].body[1]|$.body[0].body[1].body[0].body[0].orelse[0]|if-false|true
CFG|$.body[0].body[1].body[0].body[0].body[0]|$.body[0].body[1].body[0].body[0].body[1]|next|true
CFG|$.body[0].body[1].body[0].body[0]|$.body[0].body[1].body[0].body[0].body[0]|try-body|true
CFG|$.body[0].body[1].body[0].body[0].handlers[0].body[0]|$.body[0].body[1].body[0]|continue|true
CFG|$.body[0].body[1].body[0].body[0]|$.body[0].body[1].body[0].body[0].handlers[0].body[0]|except-0|true
CFG|$.body[0].body[1].body[0]|$.body[0].body[1].body[0].body[0]|loop-body|true
CFG|$.body[0].body[1].__entry__|$.body[0].body[1].body[0]|scope-entry|true
DFG|$.body[0].body[1].args.args[0]|$.body[0].body[1].body[0].test|items|true
DFG|$.body[0].body[1].args.args[0]|$.body[0].body[1].body[0].body[0].body[0].value.func.value|items|true
DFG|$.body[0].body[1].body[0].body[0].body[0].targets[0]|$.body[0].body[1].body[0].body[0].body[1].test.left|item|true
DFG|$.body[0].body[1].__external__.dfg:KeyError|$.body[0].body[1].body[0].body[0].handlers[0].type|KeyError|false
DFG|$.body[0].body[1].body[0].body[0].orelse[0].targets[0]|$.body[0].body[1].body[0].body[0].orelse[0].value.elts[0]|rest|true
DFG|$.body[0].body[1].args.vararg|$.body[0].body[1].body[0].body[0].orelse[0].value.elts[0]|rest|true
DFG|$.body[0].body[1].body[0].body[0].body[0].targets[0]|$.body[0].body[1].body[0].body[0].orelse[0].value.elts[1]|item|true
DFG|$.body[0].body[1].body[0].body[0].orelse[0].targets[0]|$.body[0].body[1].body[0].body[0].finalbody[0].value|rest|true
DFG|$.body[0].body[1].args.vararg|$.body[0].body[1].body[0].body[0].finalbody[0].value|rest|true
DFG|$.body[0].body[1].body[0].body[0].orelse[0].targets[0]|$.body[0].body[1].body[1].items[0].context_expr|rest|true
DFG|$.body[0].body[1].body[0].body[0].finalbody[0].targets[0]|$.body[0].body[1].body[1].body[0].subject|key|true
DFG|$.body[0].body[1].body[0].orelse[0].targets[0]|$.body[0].body[1].body[1].body[0].subject|key|true
DFG|$.body[0].body[1].__external__.dfg:fh|$.body[0].body[1].body[1].body[0].cases[0].body[0].value|fh|false
DFG|$.body[0].body[1].__external__.dfg:v|$.body[0].body[1].body[1].body[0].cases[1].body[0].value.elt|v|false
DFG|$.body[0].body[1].__external__.dfg:fh|$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].iter|fh|false
DFG|$.body[0].body[1].__external__.dfg:v|$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].ifs[0].value|v|false
DFG|$.body[0].body[1].body[1].items[0].optional_vars|$.body[0].body[1].body[1].body[0].cases[0].body[0].value|fh|true
DFG|$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].target|$.body[0].body[1].body[1].body[0].cases[1].body[0].value.elt|v|true
DFG|$.body[0].body[1].body[1].items[0].optional_vars|$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].iter|fh|true
DFG|$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].target|$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].ifs[0].value|v|true
DFG|$.body[0].body[1].__external__.dfg:size|$.body[0].body[1].body[2].body[0].exc.func|size|false
DFG|$.body[0].body[1].body[1].body[0].cases[1].body[0].value.generators[0].ifs[0].target|$.body[0].body[1].body[2].body[1].value|w|true
DFG|$.body[0].body[1].__external__.dfg:OSError|$.body[0].body[1].body[2].handlers[0].type|OSError|false
DFG|$.body[0].body[1].__external__.dfg:w|$.body[0].body[1].body[2].body[1].value|w|false
DFG|$.body[0].body[1].__external__.dfg:sorted|$.body[0].body[1].body[3].value.func|sorted|false
DFG|$.body[0].body[1].body[2].body[1].targets[0]|$.body[0].body[1].body[3].value.args[0]|rest|true
DFG|$.body[0].body[1].body[2].handlers[0].body[0].targets[0]|$.body[0].body[1].body[3].value.keywords[0].value|key|true
CALL|$.body[0].body[1].body[0].body[0].body[0].value|$.__external__.call:items.pop|items.pop|false
CALL|$.body[0].body[1].body[2].body[0].exc|$.__external__.call:size|size|false
CALL|$.body[0].body[1].body[3].value|$.__external__.call:sorted|sorted|false
""",
}
