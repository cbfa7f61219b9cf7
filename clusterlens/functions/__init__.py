"""Column-expression library: every function returns a built-in Spark expression."""

from .parse import (age_hours, array_task_count, base_job_id, duration_seconds, first_state, host_list,
                    limit_minutes, mem_bytes, norm_job_name, reason_token, step_base_id, tres_cpu, tres_gpu,
                    tres_mem_gb)
from .predicates import (bad_state_key, has_gpu, index_allowed, index_glob, is_bad_state, is_interactive,
                         job_in_window, lookback_start, nodelist_known, not_nan, opt_equals, path_under_roots,
                         valid_index, valid_job_id, valid_name, valid_pattern)
from .render import doc_line, format_bytes, host_of, strip_port
from .scripts import absolute_log_path, log_path, parallel_mechanisms, parallel_note, script_modules, script_paths
