"""Fixed values of the data model.

Every value in this file is part of the contract: results only agree with indexes and
monikers produced elsewhere when these are exactly as written. They are plain data, kept in
one place, in the order in which they are documented publicly.
"""

# --- Fixed values: package managers that mark a moniker as a package moniker -------------
PACKAGE_SCHEMES = ("gomod", "npm", "python", "cargo", "maven", "nuget", "pypi", "semanticdb", "proto")

# --- Fixed values: symbol role bits of the public index protocol -------------------------
ROLE_DEFINITION = 1
ROLE_IMPORT = 2
ROLE_WRITE = 4
ROLE_READ = 8
ROLE_GENERATED = 16
ROLE_TEST = 32
ROLE_FORWARD_DEFINITION = 64

# --- Fixed values: result caps and window sizes ------------------------------------------
MAX_RESULTS = 50
GREP_REFERENCE_LIMIT = 15
GREP_DEFAULT_CONTEXT = 3
GREP_MAX_CONTEXT = 10
GREP_MAX_BODY_LINES = 120
EVENT_FLOW_LIMIT = 60
MAX_RENDER_ROOTS = 40
MIN_SHA_LENGTH = 7

# --- Fixed values: tokens and path fragments that mark message producers and consumers ---
RECOGNIZER_DEFAULTS = {
    "produce": ["marshal", "encode", "serialize", "publish", "emit", "produce", "dispatch", "send", "enqueue"],
    "consume": [
        "unmarshal", "decode", "deserialize", "subscribe", "consume", "handle", "handler", "onmessage",
        "process", "receive", "listener", "callback",
    ],
    "produce_paths": ["publisher", "producer", "/emit"],
    "consume_paths": ["consumer", "subscriber", "handler", "listener"],
    "definition_markers": [".pb.go", ".pb.", "_pb2.", ".proto"],
}

# --- Fixed values: role names of an event-flow site --------------------------------------
PRODUCER = "producer"
CONSUMER = "consumer"
DEFINITION = "definition"
UNKNOWN = "unknown"

# --- Fixed values: Kubernetes kinds that receive a definition symbol ---------------------
K8S_DEFINITION_KINDS = (
    "ServiceAccount", "Role", "ClusterRole", "RoleBinding", "ClusterRoleBinding", "Secret", "ConfigMap", "Service",
    "Deployment", "StatefulSet", "DaemonSet", "Job", "CronJob", "Pod", "Ingress", "NetworkPolicy", "ReplicaSet",
)
K8S_TEMPLATE_KINDS = ("Deployment", "StatefulSet", "DaemonSet", "ReplicaSet", "Job")
K8S_DEFAULT_NAMESPACE = "default"
K8S_MONIKER_PREFIX = "scip-k8s . . . "

# --- Fixed values: Terraform language-server symbol kinds and descriptor suffixes --------
TERRAFORM_MONIKER_PREFIX = "scip-terraform . . . "
TERRAFORM_KIND_SUFFIX = {23: "#", 5: "#", 13: ".", 8: "."}

# --- Fixed values: protobuf descriptor field numbers (public descriptor.proto) -----------
PROTO_MONIKER_PREFIX = "scip-proto proto . . "
PROTO_TYPE_MESSAGE = 11
PROTO_TYPE_ENUM = 14
PROTO_NAME_FIELD = 1
PROTO_FIELD_TYPE_NAME = 6
PROTO_METHOD_INPUT = 2
PROTO_METHOD_OUTPUT = 3

# --- Fixed values: marker files that reveal the languages of a repository ----------------
# (language, base name or suffix); a suffix starts with "*".
LANGUAGE_MARKERS = (
    ("typescript", "tsconfig.json"), ("typescript", "package.json"),
    ("go", "go.mod"),
    ("python", "pyproject.toml"), ("python", "setup.py"), ("python", "setup.cfg"), ("python", "requirements.txt"),
    ("rust", "Cargo.toml"),
    ("java", "pom.xml"), ("java", "build.gradle"), ("java", "build.gradle.kts"),
    ("terraform", "*.tf"),
    ("kubernetes", "Chart.yaml"), ("kubernetes", "kustomization.yaml"),
    ("protobuf", "*.proto"),
)
LANGUAGES = ("typescript", "go", "python", "rust", "java", "terraform", "kubernetes", "protobuf")
CODE_TARGET_TYPES = ("local_code", "repository")
PROTO_WORKSPACE_FILES = ("buf.work.yaml", "buf.yaml")
