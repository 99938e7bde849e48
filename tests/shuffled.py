"""What a query shuffles."""


def bytes_shuffled(df):
    df.collect()

    def of(plan):
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            return of(plan.executedPlan())
        if plan.nodeName().endswith("QueryStage"):
            return of(plan.plan())
        own = plan.metrics().apply("shuffleBytesWritten").value() if plan.nodeName() == "Exchange" else 0
        children = plan.children()
        return own + sum(of(children.apply(i)) for i in range(children.size()))

    return of(df._jdf.queryExecution().executedPlan())
