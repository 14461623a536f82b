"""Plans: compositions of sources and operators into the study's pipelines."""
