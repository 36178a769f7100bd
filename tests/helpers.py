import contextlib
import io


def plan_text(df, mode="formatted"):
    """The ``explain`` output of ``df`` as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def files_scanned(df, below=""):
    """Files that the file scans of the executed plan of ``df`` read (collect it first); only those of a table whose path holds ``below``."""
    def scans(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return scans(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return scans(plan.plan())
        if name == "FileSourceScanExec":
            return plan.metrics().get("numFiles").get().value() if below in plan.relation().location().rootPaths().mkString(",") else 0
        children = plan.children()
        return sum(scans(children.apply(i)) for i in range(children.size()))

    return scans(df._jdf.queryExecution().executedPlan())
