"""Named operators of the pipeline: L (locations), A (attributions), D (users), Q, P."""
