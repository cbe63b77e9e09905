"""Complete analyses: marts, scoring, reports, drill-downs and the batch run."""
