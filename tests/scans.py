"""What a finished query's file scans have read, from Spark's own plan metrics."""


def nodes(df):
    """All nodes of the executed plan of a DataFrame that has been collected."""
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        out.append((name, node))
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return out


def scans(df, path):
    """Metrics of the scans of files below ``path``."""
    out = []
    for name, node in nodes(df):
        if name == "FileSourceScanExec" and path in node.relation().location().rootPaths().mkString(" "):
            metrics = node.metrics()
            out.append({m: metrics.apply(m).value() for m in ("numFiles", "numPartitions", "numOutputRows") if metrics.contains(m)})
    return out
