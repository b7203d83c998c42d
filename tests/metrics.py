"""Read SQL metrics of an executed (adaptive) plan: what each exchange shipped."""


def _metrics(node):
    out, it = {}, node.metrics().iterator()
    while it.hasNext():
        kv = it.next()
        out[kv._1()] = kv._2().value()
    return out


def exchanges(df):
    """[(child node name, shuffle records written)] for every shuffle, in plan order."""
    found = []

    def walk(p):
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(p.executedPlan())
        if "QueryStage" in name:
            return walk(p.plan())
        m = _metrics(p)
        kids = p.children()
        if "shuffleRecordsWritten" in m and name == "Exchange":
            below = kids.apply(0).nodeName() if kids.size() else ""
            if below == "WholeStageCodegen" and kids.apply(0).children().size():
                below = kids.apply(0).children().apply(0).nodeName()
            found.append((below, m["shuffleRecordsWritten"]))
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found
