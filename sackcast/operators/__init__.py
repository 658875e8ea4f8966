"""DataFrame -> DataFrame operators. None of them runs an action, except where a
function's docstring says it cuts lineage with a checkpoint."""
