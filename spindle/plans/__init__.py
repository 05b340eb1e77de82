"""Driver-side plan helpers: fixed-count / until-condition loops with a
lineage cut per step, and the mapping of the shared test tables onto
operator inputs."""
