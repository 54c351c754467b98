"""Sources and sinks: reference-format files, parquet tables, fixture views."""

from playtrail.sources.files import (overwrite_labelled, preview, read_clicks, read_labelled, read_labels,
                                     read_specs, write_csv, write_labelled, write_submission)
from playtrail.sources.fixtures import Tables, assessment_labels, clicks, specs

__all__ = ["Tables", "assessment_labels", "clicks", "specs", "preview", "read_clicks",
           "read_labelled", "read_labels", "read_specs", "write_csv", "write_labelled",
           "write_submission"]
