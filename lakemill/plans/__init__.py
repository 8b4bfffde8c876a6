"""Named jobs: business questions and layered runs, made from the operators."""
