"""What lies outside: models and sandboxes, as callables that a deployment supplies, and stand-ins for tests.

A model is ``Callable[[list[str]], list[str | None]]``: prompts in, replies out, None for a failure. It runs on the executors, for
at most ``AT_ONCE`` rows a call, and gets only rows that need it: a null prompt is not sent. Retried tasks send again, so calls should be idempotent
or their results saved (``operators.enrich`` writes each round).
"""

from __future__ import annotations

import asyncio
import json
import os
import random
import signal
import subprocess
import sys
import tempfile
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Model = Callable[[list[str]], list[str | None]]


#: Prompts that a model gets in one call at most.
AT_ONCE = 256


def ask(prompt: Column, model: Model, read: Callable[[str | None], str | None] | None = None) -> Column:
    """Replies to the prompts that are not null; with ``read``, structs of ``reply`` and what ``read`` finds in it, from the same Python
    worker. Not deterministic, so the planner never sends a prompt twice for two uses of its reply.

    Of an Arrow batch (64 MB in Spark, by its default) only ``AT_ONCE`` prompts and replies are Python objects at a time."""

    @F.arrow_udf("reply string, read string" if read else "string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        text = lambda values: pa.array(values, pa.string(), from_pandas=True)
        for batch in batches:
            for k in range(0, len(batch), AT_ONCE):
                prompts = batch.slice(k, AT_ONCE).to_pylist()
                there = [p for p in prompts if p is not None]
                got = list(model(there)) if there else []
                if len(got) != len(there):
                    raise ValueError(f"{len(got)} replies to {len(there)} prompts")
                left = iter(got)
                replies = text([None if p is None else next(left) for p in prompts])
                yield pa.StructArray.from_arrays([replies, text([read(r.as_py()) for r in replies])], ["reply", "read"]) if read else replies
            del batch  # before the next one is read

    return run.asNondeterministic()(prompt)


def canned(replies: dict[str, str], default: str | None = None) -> Model:
    """A stand-in: the reply whose key occurs in the prompt."""

    def model(prompts: list[str]) -> list[str | None]:
        return [next((v for k, v in replies.items() if k in p), default) for p in prompts]

    return model


@dataclass(frozen=True)
class HttpModel:
    """A chat-completions endpoint. ``tries`` with a pause after each failure; code ``give_up`` in an error reply ends them at once."""

    endpoint: str
    model: str
    key: str = ""
    system_prompt: str = ""
    temperature: float = 0.7
    max_tokens: int = 16_000
    timeout: float = 600.0
    tries: int = 3
    pause: float = 10.0
    concurrency: int = 5
    give_up: str = "-4003"
    post: Callable[[str, dict, dict, float], tuple[int, str]] | None = None

    def one(self, prompt: str) -> str | None:
        system = [{"role": "system", "content": self.system_prompt}] if self.system_prompt else []
        body = {"model": self.model, "messages": [*system, {"role": "user", "content": prompt}], "temperature": self.temperature, "max_tokens": self.max_tokens}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        for k in range(self.tries):
            if k:
                time.sleep(self.pause)
            try:
                status, text = (self.post or http_post)(self.endpoint, body, headers, self.timeout)
                reply = json.loads(text)
                if status == 200:
                    return reply["choices"][0]["message"]["content"]
                if str((reply.get("error") or {}).get("code")) == self.give_up:
                    return None
            except (OSError, ValueError, KeyError, IndexError, TypeError, AttributeError):
                pass
        return None

    def __call__(self, prompts: list[str]) -> list[str | None]:
        with ThreadPoolExecutor(self.concurrency) as pool:
            return list(pool.map(self.one, prompts))


def http_post(url: str, body: dict, headers: dict, timeout: float) -> tuple[int, str]:
    request = urllib.request.Request(url, json.dumps(body).encode(), headers)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return r.status, r.read().decode("utf-8")
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")


async def in_batches(prompts: list[str], call: Callable[[str], "asyncio.Future"], batch_size: int = 20, concurrency: int = 5) -> list[str | None]:
    """For asynchronous clients: batch after batch, ``concurrency`` calls at once, replies in the order of the prompts, None where a call fails."""
    gate, out = asyncio.Semaphore(concurrency), []

    async def one(p: str) -> str | None:
        async with gate:
            try:
                return await call(p)
            except Exception:
                return None

    for k in range(0, len(prompts), batch_size):
        out += await asyncio.gather(*[one(p) for p in prompts[k : k + batch_size]])
    return out


# -- code
@dataclass(frozen=True)
class Ran:
    status: str  # success, runtime_error or timeout
    stdout: str = ""
    stderr: str = ""

    @property
    def ok(self) -> bool:
        return self.status == "success"


Sandbox = Callable[[list[tuple[str, str]]], list[Ran]]


@dataclass(frozen=True)
class LocalSandbox:
    """Runs Python programs as subprocesses with limits on time, memory, processes and file size, in a folder of their own and with
    almost no environment. It bounds accidents; against hostile code the deployment has to isolate the executors or pass another sandbox."""

    timeout: float = 3.0
    memory_mb: int = 512
    processes: int = 50
    file_mb: int = 16
    concurrency: int = 4
    #: Put before the command: a wrapper that isolates it, such as ``("bwrap", "--unshare-all", ...)``.
    prefix: tuple[str, ...] = ()

    def _limits(self) -> None:
        import resource

        for what, most in ((resource.RLIMIT_AS, self.memory_mb << 20), (resource.RLIMIT_FSIZE, self.file_mb << 20), (resource.RLIMIT_CPU, int(self.timeout) + 1), (resource.RLIMIT_CORE, 0)):
            resource.setrlimit(what, (most, most))
        if os.getuid():  # for root the system sets no such limit
            resource.setrlimit(resource.RLIMIT_NPROC, (self.processes, self.processes))

    def one(self, code: str, stdin: str = "") -> Ran:
        with tempfile.TemporaryDirectory(prefix="run-") as folder:
            path = os.path.join(folder, "main.py")
            with open(path, "w", encoding="utf-8") as f:
                f.write(code)
            env = {"PATH": "/usr/bin:/bin", "HOME": folder, "TMPDIR": folder, "LANG": "C.UTF-8", "PYTHONDONTWRITEBYTECODE": "1", "OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1"}
            p = subprocess.Popen([*self.prefix, sys.executable, "-I", path], cwd=folder, env=env, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True, errors="replace", start_new_session=True, preexec_fn=self._limits)
            try:
                out, err = p.communicate(stdin + "\n" if stdin else "", timeout=self.timeout)
            except subprocess.TimeoutExpired:
                self._end(p)
                return Ran("timeout", stderr="Timeout\n")
            self._end(p)
            return Ran("success" if p.returncode == 0 else "runtime_error", out, err)

    @staticmethod
    def _end(p: subprocess.Popen) -> None:
        """The program and all it has started."""
        try:
            os.killpg(p.pid, signal.SIGKILL)
        except ProcessLookupError:
            pass
        p.wait()

    def __call__(self, tasks: list[tuple[str, str]]) -> list[Ran]:
        with ThreadPoolExecutor(self.concurrency) as pool:
            return list(pool.map(lambda t: self.one(*t), tasks))


def sandbox_server(sandbox: Sandbox, host: str = "127.0.0.1", port: int = 0):
    """The service that ``HttpSandbox`` speaks to, around any sandbox: an HTTP server, to be started with ``serve_forever``."""
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self) -> None:
            try:
                body = json.loads(self.rfile.read(int(self.headers.get("Content-Length") or 0)))
                if body.get("language", "python") != "python":
                    raise ValueError(f"language: {body['language']}")
                ran = sandbox([(body["code"], body.get("stdin") or "")])[0]
                status, reply = 200, {"status": ran.status, "run_result": {"stdout": ran.stdout, "stderr": ran.stderr}}
            except (ValueError, KeyError, AttributeError) as e:
                status, reply = 400, {"status": "bad_request", "error": str(e)}
            data = json.dumps(reply).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *a) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)


@dataclass(frozen=True)
class HttpSandbox:
    """A sandbox service: POST of code, stdin, language and time limits; a reply with ``status`` and ``run_result``."""

    endpoint: str
    language: str = "python"
    compile_timeout: float = 1.0
    run_timeout: float = 3.0
    timeout: float = 30.0
    attempts: int = 2
    pause: float = 0.0
    concurrency: int = 200
    post: Callable[[str, dict, dict, float], tuple[int, str]] | None = None

    def __post_init__(self):
        if self.language != "python":
            raise ValueError(f"language: {self.language}")

    def one(self, code: str, stdin: str = "") -> Ran:
        body = {"code": code, "stdin": stdin or "", "language": self.language, "compile_timeout": self.compile_timeout, "run_timeout": self.run_timeout}
        reply: dict = {}
        for k in range(1, self.attempts + 1):
            try:
                status, text = (self.post or http_post)(self.endpoint, body, {"Content-Type": "application/json"}, self.timeout)
                if status != 200:
                    raise OSError(f"HTTP {status}")
                reply = json.loads(text)
                break
            except (OSError, ValueError) as e:
                reply = {"status": "runtime_error", "error": str(e)}
                if k < self.attempts:
                    time.sleep(0.5 * 2 ** (k - 1) + random.random() * 0.1)
        if self.pause:
            time.sleep(self.pause)
        result = reply.get("run_result") or {}
        return Ran(reply.get("status", "runtime_error"), result.get("stdout") or "", result.get("stderr") or "")

    def __call__(self, tasks: list[tuple[str, str]]) -> list[Ran]:
        with ThreadPoolExecutor(self.concurrency) as pool:
            return list(pool.map(lambda t: self.one(*t), tasks))
