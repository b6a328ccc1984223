"""Column lists of the published views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeworks.sources.tables import publish_view

# Views and their columns, as consumers know them.
VIEWS = {
    "cluster": """organization_id workspace_name cluster_id action unixTimeMS timestamp date cluster_name
        driver_node_type node_type num_workers autoscale auto_termination_minutes enable_elastic_disk is_automated
        cluster_type security_profile cluster_log_conf init_scripts custom_tags cluster_source spark_env_vars
        spark_conf acl_path_prefix aws_attributes azure_attributes driver_instance_pool_id instance_pool_id
        driver_instance_pool_name instance_pool_name spark_version runtime_engine idempotency_token deleted_by
        created_by last_edited_by""",
    "instancePool": """organization_id workspace_name instance_pool_id serviceName timestamp date actionName
        instance_pool_name node_type_id idle_instance_autotermination_minutes min_idle_instances max_capacity
        preloaded_spark_versions azure_attributes aws_attributes custom_tags create_details delete_details
        request_details""",
    "job": """organization_id workspace_name job_id action date timestamp job_name tags tasks job_clusters libraries
        timeout_seconds max_concurrent_runs max_retries retry_on_timeout min_retry_interval_millis schedule
        existing_cluster_id new_cluster git_source task_detail_legacy is_from_dlt aclPermissionSet targetUserId
        session_id request_id user_agent response source_ip_address created_by created_ts deleted_by deleted_ts
        last_edited_by last_edited_ts""",
    "jobRun": """organization_id workspace_name job_id job_name run_id run_name multitask_parent_run_id job_run_id
        task_run_id repair_id task_key cluster_type cluster_id cluster_name job_cluster_key job_cluster new_cluster
        tags task_detail task_dependencies task_runtime task_execution_runtime task_type terminal_state
        job_trigger_type schedule libraries manual_override_params repair_details timeout_seconds retry_on_timeout
        max_retries min_retry_interval_millis max_concurrent_runs run_as_user_name parent_run_id workflow_context
        task_detail_legacy submitRun_details created_by last_edited_by request_detail time_detail""",
    "jobRunCostPotentialFact": """organization_id workspace_name job_id job_name run_id job_run_id task_run_id
        task_key repair_id run_name startEpochMS cluster_id cluster_name cluster_type cluster_tags
        driver_node_type_id node_type_id unit_rate multitask_parent_run_id parent_run_id task_runtime
        task_execution_runtime terminal_state job_trigger_type task_type created_by last_edited_by running_days
        avg_cluster_share avg_overlapping_runs max_overlapping_runs run_cluster_states worker_potential_core_H
        driver_compute_cost driver_unit_cost worker_compute_cost worker_unit_cost total_driver_cost
        total_worker_cost total_compute_cost total_unit_cost total_cost total_units spark_task_runtimeMS
        spark_task_runtime_H job_run_cluster_util""",
    "notebook": """organization_id workspace_name notebook_id notebook_name notebook_path cluster_id action
        unixTimeMS timestamp date old_name old_path new_name new_path parent_path user_email request_id response""",
    "accountMod": """organization_id workspace_name mod_unixTimeMS mod_date action endpoint modified_by user_name
        user_id group_name group_id from_ip_address user_agent request_id response""",
    "accountLogin": """organization_id workspace_name login_unixTimeMS login_date login_type login_user user_email
        ssh_login_details from_ip_address user_agent request_id response""",
    "clusterStateFact": """organization_id workspace_name cluster_id cluster_name custom_tags state_start_date
        unixTimeMS_state_start unixTimeMS_state_end timestamp_state_start timestamp_state_end state
        driver_node_type_id node_type_id current_num_workers target_num_workers uptime_since_restart_S
        uptime_in_state_S uptime_in_state_H cloud_billable platform_billable isAutomated sku runtime_engine
        unit_rate state_dates days_in_state worker_potential_core_H core_hours driver_units worker_units
        total_units driver_compute_cost worker_compute_cost driver_unit_cost worker_unit_cost total_compute_cost
        total_unit_cost total_driver_cost total_worker_cost total_cost driverSpecs workerSpecs""",
    "sparkJob": """organization_id workspace_name spark_context_id job_id job_group_id execution_id stage_ids
        cluster_id notebook_id notebook_path db_job_id db_id_in_job db_job_type unixTimeMS timestamp date
        job_runtime job_result event_log_start event_log_end user_email""",
    "sparkStage": """organization_id workspace_name spark_context_id stage_id stage_attempt_id cluster_id unixTimeMS
        timestamp date stage_runtime stage_info event_log_start event_log_end""",
    "sparkTask": """organization_id workspace_name spark_context_id task_id task_attempt_id stage_id
        stage_attempt_id cluster_id executor_id host unixTimeMS timestamp date task_runtime task_metrics task_info
        task_type task_end_reason event_log_start event_log_end""",
    "sparkExecution": """organization_id workspace_name spark_context_id execution_id cluster_id description details
        unixTimeMS timestamp date sql_execution_runtime event_log_start event_log_end""",
    "sparkStream": """organization_id workspace_name spark_context_id cluster_id stream_id stream_run_id
        stream_batch_id stream_timestamp date streamSegment stream_name streaming_metrics execution_ids""",
    "sparkExecutor": """organization_id workspace_name spark_context_id executor_id cluster_id executor_info
        removed_reason executor_alivetime unixTimeMS timestamp date event_log_start event_log_end""",
    "sql_query_history": """organization_id workspace_name warehouse_id query_id query_end_time_ms user_name user_id
        executed_as_user_id executed_as_user_name duration error_message execution_end_time_ms
        query_start_time_ms query_text rows_produced spark_ui_url statement_type status compilation_time_ms
        execution_time_ms network_sent_bytes photon_total_time_ms pruned_bytes pruned_files_count read_bytes
        read_cache_bytes read_files_count read_partitions_count read_remote_bytes result_fetch_time_ms
        result_from_cache rows_produced_count rows_read_count spill_to_disk_bytes task_total_time_ms total_time_ms
        write_remote_bytes""",
}


def view_columns(name: str) -> list[str]:
    return VIEWS[name].split()


def publish(
    df: DataFrame, name: str, tenants: list[str] | None = None, sort_by: list[str] | None = None, reverse: bool = False
) -> DataFrame:
    """Publish a gold table under its view name with the view's columns."""
    return publish_view(df, name, view_columns(name), tenants, sort_by, reverse)
