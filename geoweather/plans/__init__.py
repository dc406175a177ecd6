"""Actions: table refreshes, lake export and audited batch jobs."""
